"""Operation and survey tables derived from the generic test tables.

Every statement runs unchanged in Spark SQL (session zone UTC) and DuckDB and
reads its whole input and whole texts.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from edmart.operators.normalise import normalise_sources, normalise_universities
from edmart.sources.tables import Tables

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

STANDINS: dict[str, str] = {
    "page_hosts": """
SELECT page_id, url, split_part(url, '/', 3) AS host,
  split_part(split_part(url, '/', 3), '.', -3) AS label,
  split_part(split_part(url, '/', 3), '.', -3) || '.example.' || split_part(split_part(url, '/', 3), '.', -1) AS dom
FROM pages
""",
    "raw_sources": """
SELECT CAST(page_id AS STRING) AS source_id,
  upper(substr(label, 1, 1)) || substr(label, 2)
    || CASE page_id % 3 WHEN 0 THEN '_Undergraduate' WHEN 1 THEN ' graduate_' ELSE '' END
    || ' SRC_' || CAST(page_id AS STRING) AS source_name,
  CASE WHEN url LIKE '%?%' THEN 'catalog' ELSE 'directory' END AS source_type,
  url LIKE 'https:%' AS is_enabled,
  url AS source_base_url,
  CASE WHEN url LIKE '%?%' THEN 'https://' || host || '/schema' END AS source_schema_url,
  url LIKE '%.com/%' AS include_external,
  CAST(length(url) AS INT) AS source_crawl_depth,
  CASE WHEN host LIKE 'm.%' THEN 30 END AS page_timeout_s,
  CASE WHEN host LIKE 'www.%' THEN 4 END AS max_concurrency,
  nullif(split_part(url, '?', 2), '') AS url_base_exclude,
  nullif(split_part(url, '#', 2), '') AS url_exclude_patterns
FROM page_hosts
""",
    "raw_universities": """
SELECT CAST(min(page_id) AS INT) AS unitid,
  CASE WHEN dom LIKE '%.net' THEN label || ' University' ELSE label END AS instnm,
  label AS city,
  CASE WHEN host LIKE 'm.%' THEN 'https://www.' || dom || '/about'
    WHEN host NOT LIKE 'www.%' THEN 'http://' || host END AS webaddr,
  CAST(length(label) AS INT) AS control,
  CAST(min(page_id) AS STRING) || ' ' || label || ' Street' AS addr, upper(substr(label, 1, 2)) AS stabbr,
  lpad(CAST(min(page_id) AS STRING), 5, '0') AS zip, CAST(count(*) AS INT) AS sector,
  CAST(max(page_id) % 9 AS INT) AS c18basic, min(page_id) % 2 = 0 AS hbcu, CAST(max(page_id) % 7 AS INT) AS c21szset
FROM page_hosts
GROUP BY label, dom, host
""",
    "urls": """
SELECT CAST(o_orderkey AS STRING) AS url_id, CAST(o_custkey AS STRING) AS url_source_id,
  'https://example.org/' || CAST(o_orderkey AS STRING) AS url_link, o_orderstatus = 'F' AS is_target
FROM orders
""",
    "scraper_schemas": """
SELECT CAST(item_id AS STRING) AS scraper_schema_id, CAST(item_id AS STRING) AS scraper_schema_source_id,
  '{"characters":' || CAST(length(text) AS STRING) || ',"text":"' || text || '"}' AS scraper_schema_json
FROM benchmark
""",
    "courses": """
SELECT CAST(doc_id AS STRING) AS course_id, replace(source, 'src', '') AS course_source_id,
  course_title, nullif(substr(text, length(course_title) + 2), '') AS course_description,
  CASE WHEN lang <> 'en' THEN lang || CAST(doc_id AS STRING) END AS course_code,
  CAST(CAST(floor(n_chars / 1000) AS INT) AS STRING) AS course_credits
FROM (SELECT *, split_part(text, '.', 1) AS course_title FROM documents) d
""",
    "logs": """
SELECT event_id AS log_id, CAST(1000 + floor(hour(ts) / 8) AS INT) AS log_run_id,
  CAST(user_id AS STRING) AS log_source_id,
  CASE event_type WHEN 'click' THEN 3 WHEN 'error' THEN 0 ELSE 2 END AS log_stage,
  CASE event_type WHEN 'purchase' THEN CAST(CAST(floor(value) AS INT) AS STRING) || ' records scraped'
    WHEN 'signup' THEN 'scrape (slots left: ' || CAST(CAST(floor(value / 10) AS INT) AS STRING) || ')'
    WHEN 'view' THEN 'no data found, scraping' WHEN 'click' THEN 'writing records to storage' END AS log_message,
  ts AS log_ts
FROM events
""",
    "runs": """
SELECT CAST(1001 + o_orderkey AS INT) AS run_id,
  CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'running' END AS run_status,
  o_orderdate AS run_start_time, CASE o_orderstatus WHEN 'F' THEN o_orderdate END AS run_end_time
FROM orders
""",
    "programs_raw": """
SELECT p_partkey AS row_id, CASE p_partkey % 3
    WHEN 0 THEN '="' || lpad(CAST(p_size AS STRING), 2, '0') || '.0100"'
    WHEN 1 THEN lpad(CAST(p_size AS STRING), 2, '0') || '.01' ELSE 'n/a' END AS cipcode, p_name AS program_name
FROM part
""",
    "programs": """
SELECT CAST(lpad(CAST(p_size AS STRING), 2, '0') || '.0100' AS DECIMAL(10,4)) AS cipcode, min(p_name) AS program_name
FROM part GROUP BY p_size
""",
    "survey_completions": """
SELECT 'C' || CAST(year(l_shipdate) AS STRING) || '_A' AS table_name, CAST(year(l_shipdate) AS INT) AS report_year,
  CAST(l_suppkey AS INT) AS unitid,
  CASE WHEN l_tax = 0 THEN 'n/a'
    ELSE '="' || lpad(CAST(l_partkey % 60 AS STRING), 2, '0')
      || CASE WHEN l_discount = 0 THEN '.010049"' ELSE '.0100"' END END AS cipcode,
  l_linenumber AS award_level,
  CASE WHEN l_returnflag <> 'A' THEN CAST(floor(l_quantity) AS INT) END AS total_completions
FROM lineitem
""",
    "survey_enrollment": """
SELECT 'EFFY' || CAST(year(l_shipdate) AS STRING) AS table_name, CAST(year(l_shipdate) AS INT) AS report_year,
  CAST(l_suppkey AS INT) AS unitid, l_linestatus,
  l_linenumber AS student_level, CASE WHEN l_returnflag <> 'A' THEN CAST(floor(l_quantity) AS INT) END AS total_headcount
FROM lineitem
""",
    "survey_gradrates": """
SELECT 'GR' || CAST(year(o_orderdate) AS STRING) AS table_name, CAST(year(o_orderdate) AS INT) AS report_year,
  CAST(o_custkey AS INT) AS unitid, o_orderstatus,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS grtype,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 1000) AS INT) END AS grtotlt
FROM orders
""",
    "taxonomy01": """
SELECT CAST(r_regionkey + 1 AS STRING) AS taxonomy_id, r_name AS taxonomy_description FROM region
UNION ALL SELECT CAST(n_regionkey + 1 AS STRING) || '.' || CAST(n_nationkey AS STRING), n_name FROM nation
""",
    "course_taxonomy01": """
SELECT CAST(l.doc_id AS STRING) AS course_id,
  CAST(n.n_regionkey + 1 AS STRING) || '.' || CAST(n.n_nationkey AS STRING) AS taxonomy_id
FROM labels l JOIN nation n ON n.n_nationkey = l.doc_id % 25
""",
    "names": """
SELECT label AS source_name, url AS source_base_url FROM page_hosts
UNION ALL SELECT lower(n_name), CAST(NULL AS STRING) FROM nation
UNION ALL SELECT lang, CAST(NULL AS STRING) FROM documents
""",
    # Batches for the merges: what is stored is above (or the first of the pair).
    "university_batch": """
SELECT CAST(s_suppkey AS INT) AS unitid, s_name AS instnm, CAST(NULL AS STRING) AS city,
  'https://' || lower(s_name) || '.example.org' AS webaddr, s_nationkey AS control,
  s_name || ' Road' AS addr, 'XX' AS stabbr, CAST(s_suppkey AS STRING) AS zip, CAST(NULL AS INT) AS sector,
  CAST(length(s_name) AS INT) AS c18basic, s_acctbal > 0 AS hbcu, s_nationkey AS c21szset
FROM supplier
""",
    "program_batch": """
SELECT lpad(CAST(s_nationkey * 3 AS STRING), 2, '0') || '.0100' AS cipcode, max(s_name) AS program_name
FROM supplier GROUP BY s_nationkey
""",
    "course_batch": """
SELECT course_source_id, coalesce(course_code, '') AS course_code, course_title,
  max(lower(course_description)) AS course_description, max(course_credits || '+') AS course_credits
FROM courses c JOIN labels l ON c.course_id = CAST(l.doc_id AS STRING)
GROUP BY course_source_id, coalesce(course_code, ''), course_title
UNION ALL
SELECT CAST(turn AS STRING), CAST(NULL AS STRING), text || CAST(conv_id AS STRING), role, CAST(NULL AS STRING)
FROM conversations
""",
    "source_batch": """
SELECT source_name, 'rescan' AS source_type, CAST(NULL AS STRING) AS source_base_url,
  source_schema_url, CAST(NULL AS INT) AS source_crawl_depth, 60 AS page_timeout_s, CAST(NULL AS BOOLEAN) AS is_enabled,
  NOT include_external AS include_external, url_base_exclude || '&more' AS url_base_exclude,
  CAST(NULL AS STRING) AS url_exclude_patterns
FROM raw_sources WHERE source_type = 'catalog'
UNION ALL
SELECT s_name, 'directory', 'https://' || s_name || '.example.org', CAST(NULL AS STRING), s_nationkey, CAST(NULL AS INT),
  CASE WHEN s_acctbal < 0 THEN false END, s_acctbal > 100, CAST(NULL AS STRING), s_name
FROM supplier
""",
    "schema_batch": """
SELECT CAST(page_id AS STRING) AS scraper_schema_source_id,
  '{"page":' || CAST(length(html) AS STRING) || ',"html":"' || html || '"}' AS scraper_schema_json
FROM pages
""",
    "label_batch": """
SELECT CAST(doc_id AS STRING) AS course_id, CAST(doc_id % 5 + 1 AS STRING) AS taxonomy_id FROM documents
UNION ALL SELECT c.course_id, c.taxonomy_id
FROM course_taxonomy01 c JOIN labels l ON c.course_id = CAST(l.doc_id AS STRING) AND l.quality = 1
""",
}

# The columns that the tables store next to their own, written here as plain SQL for the oracle only.
DERIVED: dict[str, str] = {
    "sources": """
SELECT s.*,
  replace(trim(replace(replace(
    CASE WHEN strpos(lower(source_name), ' src_') > 0
      THEN left(lower(source_name), strpos(lower(source_name), ' src_') - 1) ELSE lower(source_name) END,
    'undergraduate', ''), 'graduate', ''), '_ '), '_', ' ') AS cleaned_name,
  lower(replace(left(bare || '/', strpos(bare || '/', '/')), 'www.', '')) AS src_host
FROM (SELECT *, replace(replace(source_base_url, 'http://', ''), 'https://', '') AS bare FROM raw_sources) s
""",
    "universities": """
SELECT u.*, lower(replace(left(bare || '/', strpos(bare || '/', '/')), 'www.', '')) AS uni_host
FROM (SELECT *, replace(replace(webaddr, 'http://', ''), 'https://', '') AS bare FROM raw_universities) u
""",
}


def with_clause(*names: str) -> str:
    """SQL ``WITH`` list defining ``names`` and everything they are built from."""
    order: list[str] = []

    def add(name: str) -> None:
        body = DERIVED.get(name) or STANDINS[name]
        for other in (*STANDINS, *DERIVED):
            if other != name and other not in order and _mentions(body, other):
                add(other)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({(DERIVED.get(n) or STANDINS[n]).strip()})" for n in order)


def _mentions(sql: str, name: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a.upper() in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))


@lru_cache(maxsize=8)
def load(spark: SparkSession, sf_dir: str) -> Tables:
    """All stand-ins as lazy DataFrames, derived columns computed by the library."""
    for name in BASE_TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
    frames: dict[str, DataFrame] = {}
    for name, sql in STANDINS.items():
        frames[name] = spark.sql(sql)
        frames[name].createOrReplaceTempView(name)
    frames["sources"] = normalise_sources(frames["raw_sources"])
    frames["universities"] = normalise_universities(frames["raw_universities"])
    return Tables(frames)
