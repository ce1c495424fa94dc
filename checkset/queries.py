"""Every registered query with its equivalent SQL.

Results use plain types: times as text, codes as text, no random ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import standins
from checkset.standins import with_clause
from edmart import schemas
from edmart.functions import cip, messages, times
from edmart.operators import audit, checks, counts, history, logtimes, match, merge, repair, rollup, staging, validate
from edmart.plans import linking, loads, marts
from edmart.plans.views import register_views
from edmart.operators.lineage import cut, shared_folder
from edmart.sources import survey, tables
from edmart.sources.tables import Tables, load_seed
from edmart.streaming import new_sources

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2025-06-05 15:07:09"


def query(oracle: str | None = None, uses: tuple[str, ...] = ()):
    """Register a function of the stand-in tables; ``uses`` are the tables its SQL reads."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: build(standins.load(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = (with_clause(*uses) + "\n" if uses else "") + oracle.strip()
        return build

    return register


def _now():
    return F.lit(NOW).cast("timestamp")


def _minute(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _ts(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- staging and point reads ---------------------------------------------------------------


@query("SELECT source_id, source_name, is_enabled, cleaned_name FROM sources", ("sources",))
def stg_sources(t):
    return staging.stg_sources(t.sources)


@query("SELECT source_id, source_name, is_enabled, cleaned_name FROM sources WHERE is_enabled", ("sources",))
def stg_sources_enabled(t):
    return staging.stg_sources_enabled(t.sources)


@query("SELECT url_id, url_source_id, url_link, is_target FROM urls", ("urls",))
def stg_urls(t):
    return staging.stg_urls(t.urls)


@query(
    "SELECT scraper_schema_id, scraper_schema_source_id, scraper_schema_json FROM scraper_schemas",
    ("scraper_schemas",),
)
def stg_scraper_schemas(t):
    return staging.stg_scraper_schemas(t.scraper_schemas)


@query("SELECT taxonomy_id, taxonomy_description FROM taxonomy01", ("taxonomy01",))
def stg_taxonomies(t):
    return staging.stg_taxonomies(t.taxonomy01)


@query("SELECT course_id, taxonomy_id FROM course_taxonomy01", ("course_taxonomy01",))
def stg_course_taxonomy(t):
    return staging.stg_course_taxonomy(t.course_taxonomy01)


def _audited(df, table, key):
    return audit.with_audit(df, table, user=F.lit("loader"), now=_now(), row_id=F.sha2(F.col(key).cast("string"), 256))


def _audit_sql(table: str, key: str) -> str:
    return (
        f"'loader' AS {table}_crtd_id, '{NOW}' AS {table}_crtd_dt, CAST(NULL AS VARCHAR) AS {table}_updt_id, "
        f"CAST(NULL AS VARCHAR) AS {table}_updt_dt, sha256(CAST({key} AS VARCHAR)) AS {table}_table_id"
    )


def _times_as_text(df):
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() in ("timestamp", "timestamp_ntz")]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps}) if stamps else df


@query(
    f"""SELECT course_id, course_source_id, course_title, course_description, course_code,
  {_audit_sql('courses', 'course_id')} FROM courses""",
    ("courses",),
)
def stg_courses(t):
    return _times_as_text(staging.stg_courses(_audited(t.courses, "courses", "course_id")))


@query(
    f"""SELECT log_id, log_run_id, log_source_id, log_stage, log_message, {_ts('log_ts', 'log_ts')},
  '{NOW}' AS logs_crtd_dt FROM logs""",
    ("logs",),
)
def stg_logs(t):
    return _times_as_text(staging.stg_logs(_audited(t.logs, "logs", "log_id")))


@query(
    f"""SELECT run_id, run_status, {_ts('run_start_time', 'run_start_time')}, {_ts('run_end_time', 'run_end_time')},
  {_audit_sql('runs', 'run_id')} FROM runs""",
    ("runs",),
)
def stg_runs(t):
    return _times_as_text(staging.stg_runs(_audited(t.runs, "runs", "run_id")))


@query(f"SELECT url_id, url_source_id, url_link, is_target, {_audit_sql('urls', 'url_id')} FROM urls", ("urls",))
def with_audit(t):
    return _times_as_text(_audited(t.urls, "urls", "url_id"))


@query(
    """SELECT source_id, source_name AS name, source_type AS type, source_base_url AS root_url,
  source_schema_url AS schema_url, include_external, source_crawl_depth AS crawl_depth, page_timeout_s,
  max_concurrency, url_base_exclude, url_exclude_patterns FROM sources WHERE is_enabled""",
    ("sources",),
)
def enabled_sources(t):
    return staging.enabled_sources(t.sources)


@query(
    """SELECT scraper_schema_source_id, scraper_schema_json FROM scraper_schemas ss
JOIN sources s ON s.source_id = ss.scraper_schema_source_id""",
    ("scraper_schemas", "sources"),
)
def scraper_schema(t):
    return staging.scraper_schema(t.scraper_schemas, t.sources)


@query(
    "SELECT url_source_id, url_link FROM urls u JOIN sources s ON s.source_id = u.url_source_id WHERE u.is_target",
    ("urls", "sources"),
)
def target_urls(t):
    return staging.target_urls(t.urls, t.sources)


@query(
    """SELECT course_id, course_code, course_title, course_description, course_credits FROM courses c
JOIN sources s ON s.source_id = c.course_source_id""",
    ("courses", "sources"),
)
def course_data(t):
    return staging.course_data(t.courses, t.sources)


# --- derived columns -----------------------------------------------------------------------


@query("SELECT source_name, cleaned_name FROM sources", ("sources",))
def cleaned_name(t):
    return t.sources.select("source_name", "cleaned_name")


@query("SELECT source_base_url, src_host FROM sources", ("sources",))
def src_host(t):
    return t.sources.select("source_base_url", "src_host")


@query("SELECT unitid, webaddr, uni_host FROM universities", ("universities",))
def uni_host(t):
    return t.universities.select("unitid", "webaddr", "uni_host")


def _extracted_sql(m: str) -> str:
    prefix = f"left({m}, strpos(lower({m}), ' records scraped') - 1)"
    return f"""CASE WHEN strpos(lower({m}), ' records scraped') > 0 THEN
    CASE WHEN trim({prefix}) = '' THEN 0
      WHEN regexp_full_match(trim({prefix}), '[+-]?[0-9]+') THEN try_cast({prefix} AS INT) END END"""


def _slots_sql(m: str) -> str:
    start = f"strpos(lower({m}), '(slots left:')"
    inner = f"split_part(substr({m}, {start} + 12), ')', 1)"
    return f"""CASE WHEN {m} IS NULL THEN NULL
    WHEN {start} = 0 OR strpos(substr({m}, {start}), ')') = 0 OR trim({inner}) = '' THEN 0
    WHEN regexp_full_match(trim({inner}), '[+-]?[0-9]+') THEN try_cast(trim({inner}) AS INT) END"""


@query(f"SELECT log_id, {_extracted_sql('log_message')} AS extracted_count FROM logs", ("logs",))
def extracted_count(t):
    return t.logs.select("log_id", messages.extracted_count("log_message").alias("extracted_count"))


@query(f"SELECT log_id, {_slots_sql('log_message')} AS slots_left FROM logs", ("logs",))
def slots_left(t):
    return t.logs.select("log_id", messages.slots_left("log_message").alias("slots_left"))


@query(
    """SELECT row_id, CAST(try_cast(replace(replace(cipcode, '="', ''), '"', '') AS DECIMAL(10,4)) AS VARCHAR) AS cipcode
FROM programs_raw""",
    ("programs_raw",),
)
def clean_cip(t):
    return t.programs_raw.select("row_id", cip.clean_cip("cipcode").cast("string").alias("cipcode"))


def _server_text_sql(ts: str) -> str:
    return (
        f"strftime({ts}, '%b') || ' ' || lpad(strftime({ts}, '%-d'), 2, ' ') || ' ' || strftime({ts}, '%Y') || ' ' "
        f"|| lpad(strftime({ts}, '%-I:%M'), 5, ' ') || strftime({ts}, '%p')"
    )


def _duration_sql(a: str, b: str) -> str:
    seconds = f"(CAST(epoch(date_trunc('second', {b})) AS BIGINT) - CAST(epoch(date_trunc('second', {a})) AS BIGINT))"
    day = f"(({seconds} % 86400 + 86400) % 86400)"
    return (
        f"lpad(CAST({day} // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(({day} % 3600) // 60 AS VARCHAR), 2, '0') "
        f"|| ':' || lpad(CAST({day} % 60 AS VARCHAR), 2, '0')"
    )


@query(
    f"""SELECT event_id, coalesce(strftime(ts, '%Y-%m-%d %H:%M'), '0') AS minute_text,
  strftime(ts, '%Y-%m-%d %H-%M') AS hyphen_text, {_server_text_sql('ts')} AS server_text,
  {_duration_sql("TIMESTAMP '2024-01-05 12:00:00'", 'ts')} AS duration FROM events""",
)
def time_texts(t):
    events = t.logs.select(F.col("log_id").alias("event_id"), F.col("log_ts").alias("ts"))
    start = F.lit("2024-01-05 12:00:00").cast("timestamp")
    return events.select(
        "event_id",
        times.minute_text("ts").alias("minute_text"),
        times.hyphen_minute_text("ts").alias("hyphen_text"),
        times.server_datetime_text("ts").alias("server_text"),
        times.clock_duration(start, "ts").alias("duration"),
    )


# --- counts and status marts ---------------------------------------------------------------

STATUS_TABLES = ("sources", "scraper_schemas", "urls", "courses")

# One grouped count over all things a source owns, and the greatest log per school as a struct.
STATUS_CTES = """,
owned AS (SELECT scraper_schema_source_id AS sid, 's' AS kind, NULL AS course FROM scraper_schemas
  UNION ALL SELECT url_source_id, 'u', NULL FROM urls
  UNION ALL SELECT course_source_id, 'c', struct_pack(a := course_title, b := course_description) FROM courses),
tally AS (SELECT s.cleaned_name, count(*) FILTER (kind = 's') AS n_s, count(*) FILTER (kind = 'u') AS n_u,
    count(DISTINCT course) FILTER (kind = 'c') AS n_c
  FROM owned JOIN sources s ON s.source_id = sid GROUP BY s.cleaned_name),
status AS (SELECT cleaned_name, bool_or(is_enabled) AS any_enabled, count(*) AS source_count,
    coalesce(max(n_s), 0) AS schema_count, coalesce(max(n_u), 0) AS url_count, coalesce(max(n_c), 0) AS course_count
  FROM sources LEFT JOIN tally USING (cleaned_name) GROUP BY cleaned_name),
tops AS (SELECT s.cleaned_name AS school_name,
    max(struct_pack(log_ts, log_id, log_message, log_run_id)) AS newest,
    max(struct_pack(log_ts, log_id, log_message)) FILTER (contains(lower(log_message), 'records scraped')) AS done
  FROM logs, sources s WHERE log_source_id = s.source_id GROUP BY s.cleaned_name),
latest_scrape AS (SELECT school_name, done.log_ts AS log_ts, done.log_message AS log_message FROM tops WHERE done IS NOT NULL),
latest_log AS (SELECT school_name, newest.log_message AS log_message, newest.log_run_id AS log_run_id FROM tops),
progress AS (SELECT school_name, source_count, schema_count, url_count, course_count,
    CAST(course_count > 0 AS INT) AS has_courses,
    coalesce(strftime(done.log_ts, '%Y-%m-%d %H:%M'), '0') AS last_scrape_ts,
    ['Data Present', 'Scraped, No Courses', 'Crawled, Pending Scrape', 'Schema Generated', 'Pending'][
      list_position([course_count > 0, done IS NOT NULL, url_count > 0, schema_count > 0, true], true)] AS summary_status,
    newest.log_message AS last_log, newest.log_run_id AS run_id, run_status
  FROM (SELECT cleaned_name AS school_name, * FROM status WHERE any_enabled) LEFT JOIN tops USING (school_name)
  LEFT JOIN runs ON runs.run_id = newest.log_run_id)
"""


@query(
    """SELECT cleaned_name, count(*) AS course_count FROM (
  SELECT DISTINCT cleaned_name, course_description, course_title FROM courses
  JOIN sources ON source_id = course_source_id) d GROUP BY cleaned_name""",
    ("courses", "sources"),
)
def distinct_course_counts(t):
    return counts.distinct_course_counts(t.courses, t.sources)


@query("SELECT url_source_id, count(*) AS url_count FROM urls GROUP BY url_source_id", ("urls",))
def url_counts(t):
    return counts.count_per(t.urls, "url_source_id", "url_count")


@query(STATUS_CTES + "SELECT cleaned_name, schema_count, url_count, course_count FROM status",
       (*STATUS_TABLES, "logs", "runs"))
def source_data_status(t):
    return marts.source_data_status(t)


@query(
    STATUS_CTES + "SELECT cleaned_name, source_count, schema_count, url_count, course_count FROM status WHERE any_enabled",
    (*STATUS_TABLES, "logs", "runs"),
)
def source_data_status_enabled(t):
    return marts.source_data_status_enabled(t)


@query(
    STATUS_CTES + f"""SELECT school_name, {_ts('log_ts', 'last_scrape_ts')}, log_message AS scraped_log_message
FROM latest_scrape""",
    (*STATUS_TABLES, "logs", "runs"),
)
def latest_scrape(t):
    return _times_as_text(logtimes.latest_scrape(t.logs, t.sources))


@query(
    STATUS_CTES + "SELECT school_name, log_message AS latest_log_message, log_run_id FROM latest_log",
    (*STATUS_TABLES, "logs", "runs"),
)
def latest_log(t):
    return logtimes.latest_log(t.logs, t.sources)


@query(
    STATUS_CTES + """SELECT school_name, schema_count, url_count, course_count, has_courses, last_scrape_ts,
  summary_status, last_log, run_id, run_status FROM progress""",
    (*STATUS_TABLES, "logs", "runs"),
)
def current_progress_summary(t):
    return marts.current_progress_summary(t)


@query(
    STATUS_CTES + """SELECT school_name, source_count, schema_count, url_count, course_count, last_scrape_ts,
  summary_status, run_id, run_status FROM progress""",
    (*STATUS_TABLES, "logs", "runs"),
)
def dashboard_data_summary(t):
    return marts.dashboard_data_summary(t)


# --- performance marts ---------------------------------------------------------------------


def _complete_ctes(fallback: bool) -> str:
    ts, run = ("coalesce(done_ts, any_ts)", "coalesce(done_run, any_run)") if fallback else ("done_ts", "done_run")
    return f""",
per_source AS (SELECT log_source_id AS source_id, max(log_ts) AS any_ts, max(log_run_id) AS any_run,
    max(log_ts) FILTER (contains(log_message, 'records scraped')) AS done_ts,
    max(log_run_id) FILTER (contains(log_message, 'records scraped')) AS done_run,
    max(log_ts) FILTER (contains(log_message, 'no data found, scraping')) AS start_ts
  FROM logs GROUP BY log_source_id),
complete AS (SELECT source_id, cleaned_name, source_name, {ts} AS scrape_ts, {run} AS max_run_id, start_ts
  FROM sources LEFT JOIN per_source USING (source_id)),
start AS (SELECT source_id, start_ts AS scrape_ts FROM complete),
ends AS (SELECT log_source_id AS source_id, log_ts AS scrape_ts, log_run_id AS max_run_id, log_message AS end_message
  FROM logs WHERE NOT starts_with(log_message, 'writing records')),
slots AS (SELECT log_source_id AS source_id, log_run_id AS max_run_id, true AS ended, log_ts AS slots_ts,
    log_message AS slots_message FROM logs WHERE contains(log_message, 'scrape (slots left:')),
owned AS (SELECT source_id, nullif(count(*) FILTER (k = 'u'), 0) AS url_count,
    nullif(count(*) FILTER (k = 'c'), 0) AS course_count
  FROM (SELECT url_source_id AS source_id, 'u' AS k FROM urls UNION ALL SELECT course_source_id, 'c' FROM courses)
  GROUP BY source_id),
joined AS (SELECT *, scrape_ts AS end_ts
  FROM (SELECT *, end_message IS NOT NULL AS ended FROM complete LEFT JOIN ends USING (source_id, scrape_ts, max_run_id))
  LEFT JOIN slots USING (source_id, max_run_id, ended) LEFT JOIN owned USING (source_id)
  LEFT JOIN runs ON runs.run_id = max_run_id)
"""


PERFORMANCE_TABLES = ("sources", "logs", "urls", "courses", "runs")


@query(
    _complete_ctes(True) + f"SELECT source_id, {_ts('scrape_ts', 'scrape_ts')}, max_run_id FROM complete",
    PERFORMANCE_TABLES,
)
def scrape_complete_fallback(t):
    return _times_as_text(logtimes.scrape_complete(t.sources, t.logs, fallback=True))


@query(
    _complete_ctes(False) + f"SELECT source_id, {_ts('scrape_ts', 'scrape_ts')}, max_run_id FROM complete",
    PERFORMANCE_TABLES,
)
def scrape_complete(t):
    return _times_as_text(logtimes.scrape_complete(t.sources, t.logs, fallback=False))


@query(_complete_ctes(False) + f"SELECT source_id, {_ts('scrape_ts', 'scrape_ts')} FROM start", PERFORMANCE_TABLES)
def scrape_start(t):
    return _times_as_text(logtimes.scrape_start(t.sources, t.logs))


@query(
    _complete_ctes(True) + f"""SELECT cleaned_name, source_name, run_id, run_status,
  {_ts('run_start_time', 'run_start_time')}, {_ts('run_end_time', 'run_end_time')},
  {_extracted_sql('end_message')} AS extracted_count, url_count, course_count, {_ts('slots_ts', 'start_scrape_ts')},
  {_slots_sql('slots_message')} AS slots_left,
  CASE WHEN course_count > 0 THEN {_server_text_sql('scrape_ts')} END AS courses_extracted_ts FROM joined""",
    PERFORMANCE_TABLES,
)
def scraper_performance(t):
    return _times_as_text(marts.scraper_performance(t))


@query(
    _complete_ctes(False) + f"""SELECT cleaned_name AS canonical_name, source_name, url_count, course_count, run_id,
  run_status, strftime(start_ts, '%Y-%m-%d %H-%M') AS start_scrape_ts,
  strftime(scrape_ts, '%Y-%m-%d %H-%M') AS end_scrape_ts, {_duration_sql('start_ts', 'scrape_ts')} AS scrape_time_hh_mm_ss,
  {_slots_sql('slots_message')} AS slots_left,
  CASE WHEN course_count > 0 THEN {_server_text_sql('scrape_ts')} END AS courses_extracted_date FROM joined""",
    PERFORMANCE_TABLES,
)
def dashboard_scraper_performance(t):
    return marts.dashboard_scraper_performance(t)


def _folded(t: Tables) -> Tables:
    """Logs folded by day in two loads that share one day, courses in two batches, read back merged."""
    spark = t.logs.sparkSession
    logs, courses = _new_folder(spark, "logs"), _new_folder(spark, "courses")
    day = F.to_date("log_ts")
    early, late = day <= F.lit("2024-01-15"), day >= F.lit("2024-01-15")
    rollup.fold_logs(t.logs.filter(early | day.isNull()), logs)
    rollup.fold_logs(t.logs.filter(late), logs)
    half = F.crc32(F.col("course_id")) % 2
    rollup.fold_courses(t.courses.filter(half == 0), courses, "first")
    rollup.fold_courses(t.courses.filter(half == 1), courses, "second")
    return t.with_tables(
        logs=rollup.folded_logs(spark, logs, t.logs), course_digests=rollup.folded_courses(spark, courses)
    )


@query(ORACLES["current_progress_summary"])
def progress_from_partials(t):
    return current_progress_summary(_folded(t))


@query(ORACLES["scraper_performance"])
def performance_from_partials(t):
    return scraper_performance(_folded(t))


@query(ORACLES["dashboard_scraper_performance"])
def dashboard_from_partials(t):
    return dashboard_scraper_performance(_folded(t))


@query(
    """SELECT t.taxonomy_id, t.taxonomy_description, c.course_title, c.course_description, s.cleaned_name
FROM courses c JOIN sources s ON c.course_source_id = s.source_id
JOIN course_taxonomy01 ct ON c.course_id = ct.course_id JOIN taxonomy01 t ON ct.taxonomy_id = t.taxonomy_id""",
    ("courses", "sources", "course_taxonomy01", "taxonomy01"),
)
def courses_with_taxonomy(t):
    return marts.courses_with_taxonomy(t)


@query(ORACLES["courses_with_taxonomy"])
def taxonomy_from_buckets(t):
    """The same mart from courses and labels stored in buckets of ``course_id``."""
    spark = t.courses.sparkSession

    def bucketed(name: str) -> DataFrame:
        return tables.save_bucketed(t[name], f"{name}_{uuid.uuid4().hex}", _new_folder(spark, name), "course_id", 8)

    stored = {name: bucketed(name) for name in ("courses", "course_taxonomy01")}
    return courses_with_taxonomy(t.with_tables(**stored))


# --- matching ------------------------------------------------------------------------------


@query(
    """SELECT DISTINCT n.source_name, s.cleaned_name FROM names n
LEFT JOIN (SELECT cleaned_name FROM sources WHERE is_enabled AND EXISTS (
  SELECT 1 FROM courses c WHERE c.course_source_id = sources.source_id)) s
ON contains(s.cleaned_name, n.source_name) OR contains(n.source_name, s.cleaned_name)""",
    ("names", "sources", "courses"),
)
def similar_sources(t):
    return match.similar_sources(t.names, t.sources, t.courses)


@query(
    """SELECT DISTINCT n.source_name, u.uni_host FROM names n LEFT JOIN universities u
ON contains(u.instnm, n.source_name) OR contains(n.source_name, u.instnm)""",
    ("names", "universities"),
)
def similar_universities(t):
    return match.similar_universities(t.names, t.universities)


HOST_HIT = "(s.src_host = u.uni_host OR ends_with(s.src_host, '.' || u.uni_host))"
NAME_HIT = (
    "(contains(lower(s.cleaned_name), lower(u.instnm)) OR contains(lower(u.instnm), lower(s.cleaned_name)))"
)


def _best_sql(sources: str = "sources") -> str:
    """The least (kind of match, unit, source) per source name, found among host pairs, name pairs and no pair."""
    return f"""SELECT w.cleaned_name, w.source_name, w.source_id, w.src_host, v.instnm, v.uni_host, v.unitid,
    ['host_match', 'name_match', 'no_match'][best.kind] AS match_type, CAST(1 AS BIGINT) AS rn
  FROM (SELECT source_name, min(struct_pack(kind, unitid, source_id)) AS best FROM (
      SELECT s.source_name, 1 AS kind, u.unitid, s.source_id FROM {sources} s JOIN universities u ON {HOST_HIT}
      UNION ALL SELECT s.source_name, 2, u.unitid, s.source_id FROM {sources} s JOIN universities u ON {NAME_HIT}
      UNION ALL SELECT source_name, 3, NULL, source_id FROM {sources}) GROUP BY source_name)
  JOIN {sources} w ON w.source_id = best.source_id LEFT JOIN universities v ON v.unitid = best.unitid"""


@query(_best_sql(), ("sources", "universities"))
def match_sources(t):
    return match.match_sources(t.sources, t.universities)


# --- load jobs: named yearly tables, gate, typing, union, counters and merge ------------------


def _yearly(rows: DataFrame, name: str, raw: dict[str, str], odd: list[tuple[str, DataFrame]]):
    """Named tables of text columns as a survey delivers them, one per year; lower-case names in even years."""

    def table(year: int) -> DataFrame:
        cells = [F.col(c).cast("string").alias(r if year % 2 else r.lower()) for r, c in raw.items()]
        return rows.filter(F.col("report_year") == year).select(*cells, F.lit("x").alias("NOTE"))

    years = sorted(r["report_year"] for r in rows.select("report_year").distinct().collect())  # one row a year
    named = [(name.format(y), lambda y=y: table(y)) for y in years]
    return named + [(n, lambda df=df: df) for n, df in odd]


GR_RAW = {"UNITID": "unitid", "GRTYPE": "grtype", "GRTOTLT": "grtotlt"}
EFFY_RAW = {"UNITID": "unitid", "EFFYALEV": "student_level", "EFYTOTLT": "total_headcount"}
C_A_RAW = {"UNITID": "unitid", "CIPCODE": "cipcode", "AWLEVEL": "award_level", "CTOTALT": "total_completions"}


def _gr_scan(t):
    rows = t.survey_gradrates
    odd = [("GR1980", rows.select("unitid", "grtype")), ("GR2000_L2", rows), ("HD2000", rows)]
    return survey.assemble(rows.sparkSession, _yearly(rows, "GR{}", GR_RAW, odd), "GR")


@query(
    """, named AS (SELECT DISTINCT table_name, report_year, 'read' AS outcome FROM survey_gradrates)
SELECT * FROM named UNION ALL VALUES ('GR1980', 1980, 'missing columns'), ('GR2000_L2', NULL, 'non-standard name'),
  ('HD2000', NULL, 'no survey table')""",
    ("survey_gradrates",),
)
def scan_outcomes(t):
    return survey.scan_report(t.survey_gradrates.sparkSession, _gr_scan(t))


def _load_sql(rows: str, keys: list[str], measure: str) -> str:
    """Valid rows of known units summed by key; stored facts are those of level 1, doubled."""
    k = ", ".join(keys)
    return f""", valid AS (SELECT {k}, CAST(sum({measure}) AS BIGINT) AS {measure} FROM {rows}
  WHERE unitid IN (SELECT unitid FROM universities) AND {keys[-1]} IS NOT NULL AND {measure} IS NOT NULL GROUP BY {k})
SELECT * FROM valid"""


def _stored_facts(rows: DataFrame, keys: list[str], measure: str, units: DataFrame) -> DataFrame:
    """Earlier facts of the first level: the load overwrites every one of them."""
    level = rows.filter(f"{keys[-1]} = 1 AND {measure} IS NOT NULL").join(units.select("unitid"), "unitid", "left_semi")
    return level.groupBy(*keys).agg((F.sum(measure) * 2).alias(measure))


@query(_load_sql("survey_gradrates", GRADRATE_KEYS_SQL := ["unitid", "report_year", "grtype"], "grtotlt"),
       ("survey_gradrates", "universities"))
def load_gradrates(t):
    stored = _stored_facts(t.survey_gradrates, GRADRATE_KEYS_SQL, "grtotlt", t.universities)
    load = loads.merge_gradrates(_gr_scan(t), t.universities, stored, on_duplicate="sum")
    return load.facts.select(*GRADRATE_KEYS_SQL, "grtotlt")


@query(_load_sql("survey_enrollment", ENROLLMENT_KEYS_SQL := ["unitid", "report_year", "student_level"], "total_headcount"),
       ("survey_enrollment", "universities"))
def load_enrollment(t):
    rows = t.survey_enrollment
    odd = [("EFFY_D", rows), ("EFFY1980", rows.select("unitid"))]
    scan = survey.assemble(rows.sparkSession, _yearly(rows, "EFFY{}", EFFY_RAW, odd), "EFFY")
    stored = _stored_facts(rows, ENROLLMENT_KEYS_SQL, "total_headcount", t.universities)
    load = loads.merge_enrollment(scan, t.universities, stored, on_duplicate="sum")
    return load.facts.select(*ENROLLMENT_KEYS_SQL, "total_headcount")


@query(
    """, named AS (SELECT DISTINCT table_name, report_year, 'read' AS outcome FROM survey_gradrates),
counted AS (SELECT report_year, count(*) AS n_rows, CAST(sum(grtotlt) AS BIGINT) AS grtotlt FROM survey_gradrates GROUP BY ALL)
SELECT n.*, n_rows, grtotlt FROM named n JOIN counted USING (report_year)
UNION ALL VALUES ('GR1980', 1980, 'missing columns', NULL, NULL)""",
    ("survey_gradrates",),
)
def list_tables(t):
    """Survey tables written to a folder of yearly tables, listed and scanned."""
    spark, folder = t.survey_gradrates.sparkSession, _new_folder(t.survey_gradrates.sparkSession, "survey")
    rows = t.survey_gradrates
    for k, (name, open_table) in enumerate(_yearly(rows, "GR{}", GR_RAW, [("GR1980", rows.select("unitid")), ("~GR2000", rows)])):
        open_table().write.parquet(f"{folder}/base{k % 2}/{name}.parquet")
    scan = survey.scan_survey(spark, folder, "GR")
    counts_ = scan.rows.groupBy("report_year").agg(F.count("*").alias("n_rows"), F.sum("grtotlt").alias("grtotlt"))
    report = survey.scan_report(spark, scan)
    return report.join(counts_, "report_year", "left").select("table_name", "report_year", "outcome", "n_rows", "grtotlt")


UPSERTED_SQL = """, sums AS (SELECT unitid, report_year, student_level, CAST(sum(total_headcount) AS INT) AS n
  FROM survey_enrollment WHERE total_headcount IS NOT NULL GROUP BY ALL)
SELECT report_year, unitid, student_level,
  CASE WHEN report_year >= 1996 AND student_level <= 4 THEN n WHEN student_level >= 3 THEN n * 2 END AS total_headcount
FROM sums WHERE student_level >= 3 OR report_year >= 1996 AND student_level <= 4"""


@query(UPSERTED_SQL, ("survey_enrollment",))
def upsert_years(t):
    """A stored fact table: levels from 3 on, doubled; then levels to 4 of the years from 1996 on are upserted."""
    present = t.survey_enrollment.filter("total_headcount IS NOT NULL")
    sums = cut(present.groupBy("unitid", "report_year", "student_level").agg(F.sum("total_headcount").alias("n")))
    spark, path = sums.sparkSession, _new_folder(sums.sparkSession, "enrollment")
    facts = sums.withColumn("total_headcount", F.col("n") * 2).withColumn("enrollment_id", loads.fact_id(schemas.ENROLLMENT))
    tables.save_table(schemas.conform(facts.filter("student_level >= 3"), schemas.ENROLLMENT), path, "enrollment_fact")
    batch = sums.filter("report_year >= 1996 AND student_level <= 4").withColumnRenamed("n", "total_headcount")
    years = sorted(r["report_year"] for r in batch.select("report_year").distinct().collect())  # one row a year
    loads.upsert_years(spark, path, schemas.ENROLLMENT, merge.upsert_enrollment, batch, years)
    stored = spark.read.schema(schemas.ENROLLMENT.struct).parquet(path)
    return stored.select("report_year", "unitid", F.col("student_level").cast("int").alias("student_level"), "total_headcount")


# --- merges --------------------------------------------------------------------------------


def _merge_sql(target: str, batch: str, keys: dict[str, tuple[str, str]], columns: dict[str, str]) -> str:
    """Full outer join of target t and batch s; ``columns`` maps names to SQL over t and s."""
    on = " AND ".join(f"{a} = {b}" for a, b in keys.values())
    out = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"""SELECT {out} FROM (SELECT *, 1 AS hit FROM {target}) t FULL JOIN (SELECT *, 1 AS hit FROM {batch}) s ON {on}"""


def _new(c: str) -> str:
    return f"CASE WHEN s.hit = 1 THEN s.{c} ELSE t.{c} END"


def _key(c: str) -> str:
    return f"coalesce(t.{c}, s.{c})"


UNI_COLUMNS = tuple(merge.UNIVERSITY_COLUMNS)


@query(
    _merge_sql("raw_universities", "university_batch", {"u": ("t.unitid", "s.unitid")},
               {"unitid": _key("unitid"), **{c: _new(c) for c in UNI_COLUMNS}}),
    ("raw_universities", "university_batch"),
)
def merge_universities(t):
    return merge.upsert_universities(t.raw_universities, t.university_batch).select("unitid", *UNI_COLUMNS)


@query(
    _merge_sql("programs", "(SELECT CAST(cipcode AS DECIMAL(10,4)) AS cipcode, program_name FROM program_batch)",
               {"c": ("t.cipcode", "s.cipcode")},
               {"cipcode": f"CAST({_key('cipcode')} AS VARCHAR)", "program_name": _new("program_name")}),
    ("programs", "program_batch"),
)
def merge_programs(t):
    merged = merge.upsert_programs(t.programs, t.program_batch)
    return merged.select(F.col("cipcode").cast("string").alias("cipcode"), "program_name")


def _fact_pair_sql(table: str, flag: str, stored: str, keys: list[str], measure: str) -> tuple[str, str]:
    """Stored facts and batch from one survey table, split by a status column."""
    k = ", ".join(keys)
    pick = lambda cond: (
        f"(SELECT {k}, CAST(sum({measure}) AS BIGINT) AS {measure} FROM {table} "
        f"WHERE {measure} IS NOT NULL AND {cond} GROUP BY {k})"
    )
    return pick(f"{flag} = '{stored}'"), pick(f"{flag} <> '{stored}'")


def _fact_pair(df, flag: str, stored: str, keys: list[str], measure: str):
    sums = lambda rows: rows.groupBy(*keys).agg(F.sum(measure).alias(measure))
    present = df.filter(F.col(measure).isNotNull())
    return sums(present.filter(F.col(flag) == stored)), sums(present.filter(F.col(flag) != stored))


def _fact_merge_sql(pair: tuple[str, str], keys: list[str], measure: str) -> str:
    return _merge_sql(*pair, {c: (f"t.{c}", f"s.{c}") for c in keys},
                      {**{c: _key(c) for c in keys}, measure: _new(measure)})


ENROLLMENT_KEYS = ["unitid", "report_year", "student_level"]
GRADRATE_KEYS = ["unitid", "report_year", "grtype"]


@query(
    _fact_merge_sql(_fact_pair_sql("survey_enrollment", "l_linestatus", "F", ENROLLMENT_KEYS, "total_headcount"),
                    ENROLLMENT_KEYS, "total_headcount"),
    ("survey_enrollment",),
)
def merge_enrollment(t):
    stored, batch = _fact_pair(t.survey_enrollment, "l_linestatus", "F", ENROLLMENT_KEYS, "total_headcount")
    return merge.upsert_enrollment(stored, batch)


@query(
    _fact_merge_sql(_fact_pair_sql("survey_gradrates", "o_orderstatus", "F", GRADRATE_KEYS, "grtotlt"),
                    GRADRATE_KEYS, "grtotlt"),
    ("survey_gradrates",),
)
def merge_gradrates(t):
    stored, batch = _fact_pair(t.survey_gradrates, "o_orderstatus", "F", GRADRATE_KEYS, "grtotlt")
    return merge.upsert_gradrates(stored, batch)


EXACT_SQL = """try_cast(replace(replace(cipcode, '="', ''), '"', '') AS DECIMAL(38,32))"""
LEVELS_SQL = "award_level IN (" + ", ".join(map(str, validate.AWARD_LEVELS)) + ")"
VALID_COMPLETIONS_SQL = f"""
valid AS (SELECT report_year, unitid, {EXACT_SQL} AS code, award_level, total_completions FROM survey_completions
  WHERE unitid IN (SELECT unitid FROM universities) AND {LEVELS_SQL} AND total_completions >= 0
  AND {EXACT_SQL} IN (SELECT CAST(cipcode AS DECIMAL(38,32)) FROM programs)),
sums AS (SELECT report_year, unitid, CAST(code AS DECIMAL(10,4)) AS cipcode, award_level,
  CAST(sum(total_completions) AS BIGINT) AS total_completions FROM valid GROUP BY ALL)
"""
COMPLETION_TABLES = ("survey_completions", "universities", "programs")


def _code_text(df):
    return df.withColumn("cipcode", F.col("cipcode").cast("string"))


@query(
    "," + VALID_COMPLETIONS_SQL + """SELECT report_year, unitid, CAST(CAST(code AS DECIMAL(10,4)) AS VARCHAR) AS cipcode,
  award_level, total_completions FROM valid""",
    COMPLETION_TABLES,
)
def valid_completions(t):
    return _code_text(validate.valid_completions(t.survey_completions, t.universities, t.programs))


@query(
    "," + VALID_COMPLETIONS_SQL + """SELECT report_year, unitid, CAST(cipcode AS VARCHAR) AS cipcode, award_level,
  total_completions FROM sums""",
    COMPLETION_TABLES,
)
def aggregate_completions(t):
    return _code_text(validate.completions_batch(t.survey_completions, t.universities, t.programs))


@query(
    "," + VALID_COMPLETIONS_SQL + ", stored AS (SELECT unitid, report_year, cipcode, award_level, "
    "total_completions * 2 AS total_completions FROM sums WHERE award_level < 5) "
    + _merge_sql("stored", "(SELECT * FROM sums WHERE award_level > 3)",
                 {c: (f"t.{c}", f"s.{c}") for c in ("unitid", "report_year", "cipcode", "award_level")},
                 {"unitid": _key("unitid"), "report_year": _key("report_year"),
                  "cipcode": f"CAST({_key('cipcode')} AS VARCHAR)", "award_level": _key("award_level"),
                  "total_completions": _new("total_completions")}),
    COMPLETION_TABLES,
)
def merge_completions(t):
    sums = validate.completions_batch(t.survey_completions, t.universities, t.programs)
    stored = sums.filter("award_level < 5").withColumn("total_completions", F.col("total_completions") * 2)
    batch = _code_text(sums.filter("award_level > 3"))
    return _code_text(merge.upsert_completions(stored, batch))


@query(
    "," + VALID_COMPLETIONS_SQL + """SELECT report_year, unitid, CAST(cipcode AS VARCHAR) AS cipcode, award_level,
  total_completions FROM sums""",
    COMPLETION_TABLES,
)
def load_completions(t):
    rows = t.survey_completions
    scan = survey.assemble(rows.sparkSession, _yearly(rows, "C{}_A", C_A_RAW, [("CUSTOM", rows)]), "C_A")
    sums = validate.completions_batch(rows, t.universities, t.programs)
    stored = sums.filter("award_level = 3").withColumn("total_completions", F.lit(0).cast("bigint"))
    load = loads.merge_completions(scan, t.universities, t.programs, stored)
    return _code_text(load.facts.select("report_year", "unitid", "cipcode", "award_level", "total_completions"))


THEN = "2020-01-01 00:00:00"


@query(
    f"""SELECT coalesce(b.scraper_schema_source_id, o.scraper_schema_source_id) AS scraper_schema_source_id,
  coalesce(b.scraper_schema_json, o.scraper_schema_json) AS scraper_schema_json,
  CASE WHEN o.scraper_schema_source_id IS NULL THEN 'you' ELSE 'me' END AS created_by,
  CASE WHEN o.scraper_schema_source_id IS NULL THEN '{NOW}' ELSE '{THEN}' END AS created,
  CASE WHEN o.scraper_schema_source_id = b.scraper_schema_source_id THEN 'you' END AS updated_by,
  CASE WHEN o.scraper_schema_source_id = b.scraper_schema_source_id THEN '{NOW}' END AS updated
FROM scraper_schemas o FULL JOIN schema_batch b ON b.scraper_schema_source_id = o.scraper_schema_source_id""",
    ("scraper_schemas", "schema_batch"),
)
def merge_schemas_stamped(t):
    then, name = F.lit(THEN).cast("timestamp"), "scraper_schemas"
    stored = audit.with_audit(t.scraper_schemas, name, user=F.lit("me"), now=then, row_id=F.col("scraper_schema_id"))
    merged = merge.save_schemas(stored, t.schema_batch, audit=name, user=F.lit("you"), now=_now())
    return merged.select(
        "scraper_schema_source_id",
        "scraper_schema_json",
        F.col(f"{name}_crtd_id").alias("created_by"),
        F.date_format(f"{name}_crtd_dt", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.col(f"{name}_updt_id").alias("updated_by"),
        F.date_format(f"{name}_updt_dt", "yyyy-MM-dd HH:mm:ss").alias("updated"),
    )


@query("SELECT unitid, instnm FROM universities", ("universities",))
def temporary_table_unstamped(t):
    return audit.with_audit(t.universities.select("unitid", "instnm"), "universities__dbt_tmp", user=F.lit("me"))


@query(
    """SELECT source_name, count(*) AS n_ids FROM (SELECT source_name FROM raw_sources WHERE source_type = 'catalog'
  UNION ALL SELECT s_name FROM supplier) GROUP BY source_name""",
    ("raw_sources",),
)
def upserted_source_ids(t):
    merged = merge.upsert_sources(t.raw_sources, t.source_batch)
    return merge.source_ids(merged, t.source_batch).groupBy("source_name").agg(F.count("source_id").alias("n_ids"))


@query("SELECT cleaned_name AS source_name, 'x' AS source_type, count(*) AS n FROM sources GROUP BY ALL HAVING count(*) > 1",
       ("sources",))
def conflicting_sources(t):
    return merge.source_conflicts(t.sources.select(F.col("cleaned_name").alias("source_name"), F.lit("x").alias("source_type")))


@query(
    """SELECT course_id, taxonomy_id, false AS hydrogen_related FROM course_taxonomy01""",
    ("course_taxonomy01",),
)
def conformed_labels(t):
    renamed = t.course_taxonomy01.select(F.col("taxonomy_id").alias("label"), "course_id", F.lit(1).alias("surplus"))
    fitted = schemas.conform(renamed, schemas.COURSE_TAXONOMY, renames={"label": "taxonomy_id"})
    return fitted.select("course_id", "taxonomy_id", "hydrogen_related")


@query(
    "SELECT * FROM (" + _merge_sql(
        "courses", "course_batch",
        {"s": ("t.course_source_id", "s.course_source_id"),
         "c": ("coalesce(t.course_code, '')", "coalesce(s.course_code, '')"),
         "t": ("t.course_title", "s.course_title")},
        {"course_source_id": _key("course_source_id"), "course_title": _key("course_title"),
         **{c: _new(c) for c in ("course_code", "course_description", "course_credits")}},
    ) + ") m",
    ("courses", "course_batch"),
)
def merge_courses(t):
    merged = merge.save_courses(t.courses, t.course_batch)
    return merged.select("course_source_id", "course_title", "course_code", "course_description", "course_credits")


KEPT_SOURCE_COLUMNS = ("source_crawl_depth", "page_timeout_s", "include_external", "url_base_exclude", "url_exclude_patterns")


def _kept(c: str) -> str:
    return f"coalesce(s.{c}, t.{c})"


@query(
    _merge_sql(
        "(SELECT * FROM raw_sources)", "source_batch", {"n": ("t.source_name", "s.source_name")},
        {"source_name": _key("source_name"),
         **{c: _new(c) for c in ("source_type", "source_base_url", "source_schema_url")},
         **{c: _kept(c) for c in KEPT_SOURCE_COLUMNS},
         "is_enabled": "coalesce(s.is_enabled, t.is_enabled, true)"},
    ),
    ("raw_sources", "source_batch"),
)
def merge_sources(t):
    merged = merge.upsert_sources(t.raw_sources, t.source_batch)
    return merged.select(
        "source_name", "source_type", "source_base_url", "source_schema_url", *KEPT_SOURCE_COLUMNS, "is_enabled"
    )


@query(
    _merge_sql("scraper_schemas", "schema_batch",
               {"s": ("t.scraper_schema_source_id", "s.scraper_schema_source_id")},
               {"scraper_schema_source_id": _key("scraper_schema_source_id"),
                "scraper_schema_json": _new("scraper_schema_json")}),
    ("scraper_schemas", "schema_batch"),
)
def merge_schemas(t):
    merged = merge.save_schemas(t.scraper_schemas, t.schema_batch)
    return merged.select("scraper_schema_source_id", "scraper_schema_json")


@query(
    """SELECT course_id, taxonomy_id FROM course_taxonomy01 UNION ALL
SELECT course_id, taxonomy_id FROM label_batch b WHERE NOT EXISTS (SELECT 1 FROM course_taxonomy01 c
  WHERE c.course_id = b.course_id AND c.taxonomy_id = b.taxonomy_id)""",
    ("course_taxonomy01", "label_batch"),
)
def insert_course_taxonomy(t):
    return merge.save_course_taxonomy(t.course_taxonomy01, t.label_batch)


# --- survey validity -----------------------------------------------------------------------


@query(
    """SELECT report_year, unitid, grtype, grtotlt FROM survey_gradrates
WHERE unitid IN (SELECT unitid FROM universities) AND grtype IS NOT NULL AND grtotlt IS NOT NULL""",
    ("survey_gradrates", "universities"),
)
def valid_gradrates(t):
    return validate.valid_gradrates(t.survey_gradrates, t.universities)


@query(
    """SELECT report_year, unitid, student_level, total_headcount FROM survey_enrollment
WHERE unitid IN (SELECT unitid FROM universities) AND student_level IS NOT NULL AND total_headcount IS NOT NULL""",
    ("survey_enrollment", "universities"),
)
def valid_enrollment(t):
    return validate.valid_enrollment(t.survey_enrollment, t.universities)


@query(
    f""", judged AS (SELECT table_name, report_year, coalesce(unitid IN (SELECT unitid FROM universities)
    AND {LEVELS_SQL} AND total_completions >= 0
    AND {EXACT_SQL} IN (SELECT CAST(cipcode AS DECIMAL(38,32)) FROM programs), false) AS good FROM survey_completions)
SELECT table_name, report_year, count(*) FILTER (good) AS extracted, count(*) FILTER (NOT good) AS skipped
FROM judged GROUP BY ALL""",
    COMPLETION_TABLES,
)
def load_report(t):
    return validate.completions_report(t.survey_completions, t.universities, t.programs)


def _measures_report_sql(table: str, columns: str) -> str:
    return f""", judged AS (SELECT table_name, report_year,
  coalesce(unitid IN (SELECT unitid FROM universities), false) AS known, {columns} AS present FROM {table})
SELECT table_name, report_year, count(*) FILTER (known AND present) AS extracted,
  count(*) FILTER (NOT known) AS skipped FROM judged GROUP BY ALL"""


@query(
    _measures_report_sql("survey_gradrates", "(grtype IS NOT NULL AND grtotlt IS NOT NULL)"),
    ("survey_gradrates", "universities"),
)
def load_report_gradrates(t):
    return validate.measures_report(t.survey_gradrates, t.universities, ["grtype", "grtotlt"])


@query(
    _measures_report_sql("survey_enrollment", "(student_level IS NOT NULL AND total_headcount IS NOT NULL)"),
    ("survey_enrollment", "universities"),
)
def load_report_enrollment(t):
    return validate.measures_report(t.survey_enrollment, t.universities, ["student_level", "total_headcount"])


def _load_counts_sql(table: str, columns: str) -> str:
    return _measures_report_sql(table, columns).replace("SELECT table_name, report_year, count", "SELECT report_year, count")


@query(ORACLES["load_report"].replace("SELECT table_name, report_year, count", "SELECT report_year, count"))
def load_completions_counters(t):
    """Counters that come with the load, from the rows graded for its batch."""
    rows = t.survey_completions
    scan = survey.assemble(rows.sparkSession, _yearly(rows, "C{}_A", C_A_RAW, []), "C_A")
    stored = validate.completions_batch(rows, t.universities, t.programs)
    return loads.merge_completions(scan, t.universities, t.programs, stored).report.drop("table_name")


@query(_load_counts_sql("survey_gradrates", "(grtype IS NOT NULL AND grtotlt IS NOT NULL)"),
       ("survey_gradrates", "universities"))
def load_gradrates_counters(t):
    stored = _stored_facts(t.survey_gradrates, GRADRATE_KEYS_SQL, "grtotlt", t.universities)
    load = loads.merge_gradrates(_gr_scan(t), t.universities, stored, on_duplicate="sum")
    return load.report.drop("table_name")


# --- repair, links, integrity, history -----------------------------------------------------

REPAIRED_SQL = """coalesce(CASE WHEN cipcode LIKE '="%"' THEN
  try_cast(replace(replace(cipcode, '="', ''), '"', '') AS DECIMAL(10,4)) END, try_cast(cipcode AS DECIMAL(10,4)))"""


@query(
    f"SELECT row_id, CAST(coalesce({REPAIRED_SQL}, 0) AS DECIMAL(10,4))::VARCHAR AS cipcode, program_name FROM programs_raw",
    ("programs_raw",),
)
def repair_cip(t):
    return _code_text(repair.repair_cip(t.programs_raw))


@query(
    f"""SELECT row_id, CAST(code AS VARCHAR) AS cipcode, program_name FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY cipcode, row_id) AS rn
  FROM (SELECT *, {REPAIRED_SQL} AS code FROM programs_raw) p) q WHERE rn = 1""",
    ("programs_raw",),
)
def dedupe_programs(t):
    return _code_text(repair.dedupe_programs(t.programs_raw))


@query(
    f"""SELECT report_year, unitid, CAST(coalesce(code, 0) AS DECIMAL(10,4))::VARCHAR AS cipcode, award_level, total_completions
FROM (SELECT *, {REPAIRED_SQL} AS code FROM survey_completions) f
WHERE code IS NULL OR code IN (SELECT {REPAIRED_SQL} FROM programs_raw WHERE {REPAIRED_SQL} IS NOT NULL)""",
    ("survey_completions", "programs_raw"),
)
def drop_orphans(t):
    _, facts = repair.repair_programs_and_facts(t.programs_raw, t.survey_completions)
    return _code_text(facts).select("report_year", "unitid", "cipcode", "award_level", "total_completions")


@query(
    "SELECT DISTINCT sha256(cleaned_name) AS distinct_id, cleaned_name AS distinct_name FROM sources", ("sources",)
)
def register_distinct(t):
    return linking.register_distinct(t.sources).select("distinct_id", "distinct_name")


@query("SELECT source_id, source_name, sha256(cleaned_name) AS source_distinct_id FROM sources", ("sources",))
def link_sources(t):
    linked = linking.link_sources(t.sources, linking.register_distinct(t.sources))
    return linked.select("source_id", "source_name", "source_distinct_id")


def _stamps_sql(sources: str) -> str:
    return f"""SELECT u.unitid, u.instnm, m.university_distinct_id FROM universities u LEFT JOIN (
  SELECT unitid, sha256(min(cleaned_name)) AS university_distinct_id
  FROM ({_best_sql(sources)}) r GROUP BY unitid) m ON m.unitid = u.unitid"""


@query(_stamps_sql("sources"), ("sources", "universities"))
def back_fill_universities(t):
    linked = linking.link_sources(t.sources, linking.register_distinct(t.sources))
    return linking.back_fill_universities(linked, t.universities).select("unitid", "instnm", "university_distinct_id")


@query(
    f""", fresh AS (SELECT * FROM sources WHERE source_type = 'catalog')
SELECT 'name' AS kind, sha256(cleaned_name) AS id, cleaned_name AS value FROM (SELECT DISTINCT cleaned_name FROM sources) d
UNION ALL SELECT 'source', source_id, sha256(cleaned_name) FROM sources
UNION ALL SELECT 'university', CAST(unitid AS VARCHAR), university_distinct_id FROM ({_stamps_sql('fresh')}) s""",
    ("sources", "universities"),
)
def new_sources_pipeline(t):
    is_new = F.col("source_type") == "catalog"
    before = t.sources.filter(~is_new)
    known = linking.register_distinct(before)
    stored = linking.link_sources(before, known).unionByName(t.sources.filter(is_new), allowMissingColumns=True)
    out = linking.on_new_sources(t.sources.filter(is_new), stored, known, t.universities)
    names = out.distinct_sources.select(F.lit("name").alias("kind"), F.col("distinct_id").alias("id"),
                                        F.col("distinct_name").alias("value"))
    sources = out.sources.select(F.lit("source").alias("kind"), F.col("source_id").alias("id"),
                                 F.col("source_distinct_id").alias("value"))
    unis = out.universities.select(F.lit("university").alias("kind"), F.col("unitid").cast("string").alias("id"),
                                   F.col("university_distinct_id").alias("value"))
    return names.unionByName(sources).unionByName(unis)


NAMES_LINKS_STAMPS_SQL = f"""
SELECT 'name' AS kind, sha256(cleaned_name) AS id, cleaned_name AS value FROM (SELECT DISTINCT cleaned_name FROM sources) d
UNION ALL SELECT 'source', source_id, sha256(cleaned_name) FROM sources
UNION ALL SELECT 'university', CAST(unitid AS VARCHAR), university_distinct_id FROM ({_stamps_sql('sources')}) s"""


@query(NAMES_LINKS_STAMPS_SQL, ("sources", "universities"))
def stream_new_sources(t):
    """All sources as a stream: names from the state store, links and stamps per micro-batch."""
    spark, folder = t.raw_sources.sparkSession, _new_folder(t.raw_sources.sparkSession, "stream")
    raw = t.raw_sources.select("source_id", "source_name", "source_base_url")
    raw.write.parquet(f"{folder}/inbox")
    stream = spark.readStream.schema(raw.schema).parquet(f"{folder}/inbox")
    new_sources.start(stream, f"{folder}/out", f"{folder}/progress", lambda: t.universities).awaitTermination()
    names = new_sources.distinct_sources(spark, f"{folder}/out")
    linked = new_sources.linked_sources(spark, f"{folder}/out", t.sources)
    unis = new_sources.stamped_universities(spark, f"{folder}/out", t.universities)
    return (
        names.select(F.lit("name").alias("kind"), F.col("distinct_id").alias("id"), F.col("distinct_name").alias("value"))
        .unionByName(linked.select(F.lit("source").alias("kind"), F.col("source_id").alias("id"), F.col("source_distinct_id").alias("value")))
        .unionByName(unis.select(F.lit("university").alias("kind"), F.col("unitid").cast("string").alias("id"), F.col("university_distinct_id").alias("value")))
    )


@query(
    """, old AS (SELECT * FROM universities WHERE unitid % 2 = 0)
SELECT source_name, unitid, match_type FROM (""" + _best_sql() + ") b",
    ("sources", "universities"),
)
def rematch_on_new_universities(t):
    """Sources matched to half of the universities, then to the other half alone."""
    new = F.col("unitid") % 2 != 0
    before = cut(match.choices(t.sources, match.UniversityIndex.build(t.universities.filter(~new))))
    best = linking.on_new_universities(before, t.sources, t.universities.filter(new))
    return best.select("source_name", "best.unitid", "best.match_type")


@query(
    f"""SELECT run_id, CASE WHEN hit THEN 'finished' ELSE run_status END AS run_status,
  {_ts('run_start_time', 'run_start_time')},
  CASE WHEN hit THEN '{NOW}' ELSE strftime(run_end_time, '%Y-%m-%d %H:%M:%S') END AS run_end_time
FROM (SELECT *, run_id IN (SELECT log_run_id FROM logs) AS hit FROM runs) r""",
    ("runs", "logs"),
)
def close_runs(t):
    ids = t.logs.select(F.col("log_run_id").alias("run_id"))
    return _times_as_text(repair.close_runs(t.runs, ids, _now().cast("timestamp_ntz")))


@query(
    """SELECT 'sources' AS table_name, source_id AS id FROM sources WHERE is_enabled
UNION ALL SELECT 'logs', CAST(log_id AS VARCHAR) FROM logs
WHERE log_source_id NOT IN (SELECT source_id FROM sources WHERE NOT is_enabled)""",
    ("sources", "logs"),
)
def cascade_delete(t):
    left = repair.delete_cascade({"sources": t.sources, "logs": t.logs}, "sources", t.sources.filter("NOT is_enabled"))
    return left["sources"].select(F.lit("sources").alias("table_name"), F.col("source_id").alias("id")).unionByName(
        left["logs"].select(F.lit("logs").alias("table_name"), F.col("log_id").cast("string").alias("id"))
    )


@query(
    """SELECT course_id, taxonomy_id FROM course_taxonomy01
WHERE course_id NOT IN (SELECT course_id FROM courses WHERE course_code IS NULL)""",
    ("courses", "course_taxonomy01"),
)
def cascade_labels(t):
    tables = {"courses": t.courses, "course_taxonomy01": t.course_taxonomy01}
    return repair.delete_cascade(tables, "courses", t.courses.filter("course_code IS NULL"))["course_taxonomy01"]


@query(
    """SELECT t.taxonomy_id, t.taxonomy_description, c.course_title, c.course_description, s.cleaned_name
FROM course_taxonomy01 ct, taxonomy01 t, courses c, sources s
WHERE t.taxonomy_id = ct.taxonomy_id AND c.course_id = ct.course_id AND s.source_id = c.course_source_id""",
    ("courses", "sources", "course_taxonomy01", "taxonomy01"),
)
def view_of_course_details(t):
    (name,) = register_views(t, ["dim_courses_with_details"])
    return t.courses.sparkSession.table(name)


@query(
    """SELECT DISTINCT CAST(log_stage AS SMALLINT) AS stage_id, 'seen' AS stage_name FROM logs
UNION ALL SELECT CAST(i AS SMALLINT), n
FROM (VALUES (0, 'crawl'), (1, 'schema'), (2, 'scrape'), (3, 'storage'), (4, 'classify')) v(i, n)
WHERE i NOT IN (SELECT log_stage FROM logs)""",
    ("logs",),
)
def log_stage_seed(t):
    seen = t.logs.select(F.col("log_stage").cast("smallint").alias("stage_id"), F.lit("seen").alias("stage_name"))
    return load_seed(t.logs.sparkSession, "log_stages", into=seen.distinct())


def load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tables by name, as views: rows per nation and region."""
    Tables.load(spark, sf_dir, ("nation", "region", "customer"), views=True, suffix=".parquet")
    return spark.sql(
        """SELECT r_name, n_name, count(c_custkey) AS n_customers FROM region JOIN nation ON n_regionkey = r_regionkey
LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name, n_name"""
    )


QUERIES["load_tables"] = load_tables
ORACLES["load_tables"] = """SELECT r_name, n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers
FROM nation, region WHERE r_regionkey = n_regionkey"""


@query(
    """SELECT 'courses' AS table_name, course_source_id AS id, count(*) AS n FROM courses
WHERE course_source_id IN (SELECT source_id FROM sources WHERE NOT is_enabled) GROUP BY course_source_id
UNION ALL SELECT 'urls', url_source_id, count(*) FROM urls
WHERE url_source_id IN (SELECT source_id FROM sources WHERE NOT is_enabled) GROUP BY url_source_id""",
    ("sources", "courses", "urls"),
)
def cascade_blockers(t):
    return repair.delete_blockers(
        {"courses": t.courses, "urls": t.urls}, "sources", t.sources.filter("NOT is_enabled")
    )


@query(
    """SELECT url_source_id, count(*) AS n FROM urls
WHERE url_source_id NOT IN (SELECT source_id FROM sources) GROUP BY url_source_id""",
    ("urls", "sources"),
)
def fk_check(t):
    return checks.check_fk(t.urls, "url_source_id", t.sources, "source_id")


@query(
    """SELECT course_source_id, course_title, count(*) AS n FROM courses
GROUP BY course_source_id, course_title HAVING count(*) > 1""",
    ("courses",),
)
def unique_check(t):
    return checks.check_unique(t.courses, ["course_source_id", "course_title"])


@query(
    """SELECT 'source_base_url' AS column_name, 'too long' AS problem, count(*) AS n FROM sources
  WHERE length(source_base_url) > 200 HAVING count(*) > 0
UNION ALL SELECT 'source_name', 'too long', count(*) FROM sources WHERE length(source_name) > 50 HAVING count(*) > 0
UNION ALL SELECT 'source_type', 'too long', count(*) FROM sources WHERE length(source_type) > 8 HAVING count(*) > 0
UNION ALL SELECT 'source_schema_url', 'null', count(*) FROM sources WHERE source_schema_url IS NULL HAVING count(*) > 0""",
    ("sources",),
)
def column_check(t):
    from edmart.schemas import Col, Table

    spec = Table(
        "sources",
        (
            Col("source_base_url", "string", False, 200), Col("source_name", "string", True, 50),
            Col("source_type", "string", True, 8), Col("source_schema_url", "string", True),
        ),
        ("source_id",),
    )
    return checks.check_columns(t.sources, spec)


SNAPSHOT_SQL = """,
details AS (SELECT ct.taxonomy_id || '-' || coalesce(c.course_title, '') || '-' || c.course_id AS history_key,
    x.taxonomy_description, c.course_description, s.cleaned_name
  FROM course_taxonomy01 ct, taxonomy01 x, courses c, sources s
  WHERE x.taxonomy_id = ct.taxonomy_id AND c.course_id = ct.course_id AND s.source_id = c.course_source_id),
versions AS (SELECT d.*, cleaned_name LIKE '%th%' AS stored, lower(course_description) AS before,
  lower(course_description) IS DISTINCT FROM course_description AS changed FROM details d)
"""


@query(
    SNAPSHOT_SQL + f"""SELECT history_key, taxonomy_description, before AS course_description, cleaned_name,
  '2025-01-01 00:00:00' AS valid_from, CASE WHEN changed THEN '{NOW}' END AS valid_to FROM versions WHERE stored
UNION ALL SELECT history_key, taxonomy_description, course_description, cleaned_name, '{NOW}', NULL
FROM versions WHERE NOT coalesce(stored, false) OR changed""",
    ("courses", "sources", "course_taxonomy01", "taxonomy01"),
)
def scd2_snapshot(t):
    # one title is taught by several schools, so the course id is part of the key
    ids = t.courses.select("course_id", "course_source_id", "course_title", "course_description")
    details = (
        t.course_taxonomy01.join(t.taxonomy01, "taxonomy_id")
        .join(ids, "course_id")
        .join(t.sources.select(F.col("source_id").alias("course_source_id"), "cleaned_name"), "course_source_id")
    )
    rows = history.course_snapshot_rows(details, ["taxonomy_id", "course_title", "course_id"])
    watched = ["taxonomy_description", "course_description", "cleaned_name"]
    rows = cut(rows.select("history_key", *watched))  # stored rows of the mart
    old = rows.filter("cleaned_name LIKE '%th%'").withColumn("course_description", F.lower("course_description"))
    opened = history.start_history(old, F.lit("2025-01-01 00:00:00"))
    return _times_as_text(history.scd2(opened, rows, "history_key", watched, _now()))


@query(
    """, states AS (SELECT log_source_id, CAST(date_trunc('day', log_ts) AS DATE) AS day, max(log_stage) AS top, count(*) AS n
  FROM logs GROUP BY ALL),
starts AS (SELECT * FROM states QUALIFY lag(top) OVER (PARTITION BY log_source_id ORDER BY day) IS DISTINCT FROM top
  OR row_number() OVER (PARTITION BY log_source_id ORDER BY day) = 1)
SELECT log_source_id, top, n, CAST(day AS VARCHAR) AS valid_from,
  CAST(lead(day) OVER (PARTITION BY log_source_id ORDER BY day) AS VARCHAR) AS valid_to FROM starts""",
    ("logs",),
)
def history_from_states(t):
    """The highest stage of each source, day by day, as a history; ``n`` is that of a version's first day."""
    states = t.logs.groupBy("log_source_id", F.to_date("log_ts").alias("day")).agg(
        F.max("log_stage").alias("top"), F.count("*").alias("n")
    )
    found = history.from_states(states, "log_source_id", "day", ["top"])
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("valid_from", "valid_to")})


@query(
    f"""SELECT run_id, run_status, {_ts('CASE WHEN run_id % 3 > 0 THEN run_start_time END', 'run_start_time')},
  {_ts('CASE WHEN run_id % 3 = 2 THEN run_end_time END', 'run_end_time')} FROM runs""",
    ("runs",),
)
def load_versions(t):
    """Runs stored in three versions: an old name and no times, then a start time, then all columns."""
    spark, path = t.runs.sparkSession, _new_folder(t.runs.sparkSession, "versions")
    third = lambda k: t.runs.filter(F.col("run_id") % 3 == k)
    third(0).select("run_id", F.col("run_status").alias("state"), F.lit(1).alias("host")).write.parquet(f"{path}/version=1")
    third(1).select("run_id", "run_status", "run_start_time").write.parquet(f"{path}/version=2")
    third(2).select("run_id", "run_status", "run_start_time", "run_end_time").write.parquet(f"{path}/version=3")
    steps = {1: schemas.Step(renames={"state": "run_status"}, drops=("host",)), 2: schemas.Step(adds={"run_end_time": None})}
    found = tables.load_versions(spark, path, schemas.TABLES["runs"], steps, newest=3)
    return _times_as_text(found.select("run_id", "run_status", "run_start_time", "run_end_time"))
