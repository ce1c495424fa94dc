"""Progress and performance marts over the operation tables. Results are lazy unless staged.

Courses count from ``course_digests`` where the tables have one (``operators.rollup``), else from ``courses``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.functions import messages as M
from edmart.functions import times
from edmart.operators.counts import count_per, distinct_course_counts, distinct_digest_counts, school_counts
from edmart.operators.joins import lookup_join
from edmart.operators.lineage import cut
from edmart.operators.logtimes import school_log_summary, scrape_times
from edmart.sources.tables import Tables


def summary_status(course_count: Column, last_scrape_ts: Column, url_count: Column, schema_count: Column) -> Column:
    """Progress of a school; the first condition that holds wins."""
    # The status texts.
    return (
        F.when(course_count > 0, "Data Present")
        .when(last_scrape_ts.isNotNull(), "Scraped, No Courses")
        .when(url_count > 0, "Crawled, Pending Scrape")
        .when(schema_count > 0, "Schema Generated")
        .otherwise("Pending")
    )


def _status(t: Tables) -> DataFrame:
    counts = school_counts(t.sources, t.scraper_schemas, t.urls)
    if "course_digests" in t:
        courses = distinct_digest_counts(t.course_digests, t.sources)
    else:
        courses = distinct_course_counts(t.courses, t.sources)
    return counts.join(courses, "cleaned_name", "left").withColumn(
        "course_count", F.coalesce("course_count", F.lit(0))
    )


def source_data_status(t: Tables) -> DataFrame:
    """Per school name over all sources: schema, url and distinct course counts."""
    return _status(t).select("cleaned_name", "schema_count", "url_count", "course_count")


def source_data_status_enabled(t: Tables) -> DataFrame:
    """Names with an enabled source; the counts still cover every source of the name."""
    return (
        _status(t)
        .filter("any_enabled")
        .select("cleaned_name", "source_count", "schema_count", "url_count", "course_count")
    )


def _progress(t: Tables) -> DataFrame:
    status = source_data_status_enabled(t)
    logs = school_log_summary(t.logs, t.sources).withColumnRenamed("school_name", "cleaned_name")
    runs = t.runs.select(F.col("run_id").alias("log_run_id"), "run_status")
    return (
        status.join(logs, "cleaned_name", "left")
        .join(runs, "log_run_id", "left")
        .select(
            F.col("cleaned_name").alias("school_name"),
            "source_count",
            "schema_count",
            "url_count",
            "course_count",
            F.when(F.col("course_count") > 0, 1).otherwise(0).alias("has_courses"),
            times.minute_text("last_scrape_ts").alias("last_scrape_ts"),
            summary_status(
                F.col("course_count"), F.col("last_scrape_ts"), F.col("url_count"), F.col("schema_count")
            ).alias("summary_status"),
            F.col("latest_log_message").alias("last_log"),
            F.col("log_run_id").alias("run_id"),
            "run_status",
        )
    )


def current_progress_summary(t: Tables) -> DataFrame:
    return _progress(t).drop("source_count")


def dashboard_data_summary(t: Tables) -> DataFrame:
    return _progress(t).drop("has_courses", "last_log")


def _with_end_log(spine: DataFrame, logs: DataFrame) -> DataFrame:
    """Add the log message at (source, scrape_ts, max_run_id), one row per such log row.

    The inner join reduces the logs to those rows first: with few sources it is a
    broadcast of three columns and no log row is shuffled; with many, a hot key is
    split by AQE. The outer join then only meets the reduced rows.
    """
    on = ["source_id", "scrape_ts", "max_run_id"]
    at_end = (
        logs.filter(M.is_not_writing("log_message"))
        .select(
            F.col("log_source_id").alias("source_id"),
            F.col("log_ts").alias("scrape_ts"),
            F.col("log_run_id").alias("max_run_id"),
            F.col("log_message").alias("end_message"),
        )
        .join(spine.select(*on), on)
    )
    return spine.join(at_end, on, "left")


SPREAD = 64


def _with_slots_log(rows: DataFrame, logs: DataFrame) -> DataFrame:
    """Add every slots-left message of the end log's run and source, or NULL without one.

    ``slots_rows`` already tells which rows have a partner. The others get one of ``SPREAD`` empty messages, so one
    inner join over one reading of ``rows`` does for both, and a hot (source, run) is split on either side.
    """
    expects = F.coalesce(F.col("end_message").isNotNull() & (F.col("slots_rows") > 0), F.lit(False))
    slots = logs.filter(M.is_slots("log_message")).select(
        F.lit(True).alias("has_slots"),
        F.col("log_source_id").alias("slots_source"),
        F.col("log_run_id").cast("long").alias("slots_run"),
        F.col("log_ts").alias("slots_ts"),
        F.col("log_message").alias("slots_message"),
    )
    kinds = {f.name: f.dataType for f in slots.schema}
    empty = rows.sparkSession.range(SPREAD).select(
        F.lit(False).alias("has_slots"),
        F.lit("").cast(kinds["slots_source"]).alias("slots_source"),
        F.col("id").alias("slots_run"),
        *[F.lit(None).cast(kinds[c]).alias(c) for c in ("slots_ts", "slots_message")],
    )
    place = F.pmod(F.xxhash64("source_id"), F.lit(SPREAD))
    keyed = rows.withColumns(
        {
            "has_slots": expects,
            "slots_source": F.when(expects, F.col("source_id")).otherwise(F.lit("").cast(kinds["slots_source"])),
            "slots_run": F.when(expects, F.col("max_run_id").cast("long")).otherwise(place),
        }
    )
    key = ["has_slots", "slots_source", "slots_run"]
    return keyed.join(slots.unionByName(empty), key).drop(*key)


def _courses_per_source(t: Tables) -> DataFrame:
    key = F.col("course_source_id").alias("source_id")
    if "course_digests" in t:
        return t.course_digests.groupBy(key).agg(F.sum("n").alias("course_count"))
    return t.courses.groupBy(key).agg(F.count("*").alias("course_count"))


def _performance(t: Tables, fallback: bool, stage: bool) -> DataFrame:
    """One row per source with everything that is single per source, then the fan-out joins.

    The per-source times come from a pass over all logs and are used twice. With
    ``stage`` they are stored in the checkpoint folder first, which saves that pass.
    """
    urls = count_per(t.urls.withColumnRenamed("url_source_id", "source_id"), "source_id", "url_count")
    courses = _courses_per_source(t)
    runs = t.runs.select(
        F.col("run_id").alias("max_run_id"), "run_id", "run_status", "run_start_time", "run_end_time"
    )
    scraped = scrape_times(t.sources, t.logs, fallback)
    spine = (
        (cut(scraped) if stage else scraped)
        .join(t.sources.select("source_id", "source_name", "cleaned_name"), "source_id")
        .join(urls, "source_id", "left")
        .join(courses, "source_id", "left")
        .transform(lookup_join, runs, "max_run_id", "left")
    )
    return _with_slots_log(_with_end_log(spine, t.logs), t.logs)


def _extraction_text() -> Column:
    return F.when(F.col("course_count") > 0, times.server_datetime_text("scrape_ts"))


def scraper_performance(t: Tables, stage: bool = False) -> DataFrame:
    """Per source: its last run, extracted count, url and course counts, slots left."""
    return _performance(t, fallback=True, stage=stage).select(
        "cleaned_name",
        "source_name",
        "run_id",
        "run_status",
        "run_start_time",
        "run_end_time",
        M.extracted_count("end_message").alias("extracted_count"),
        "url_count",
        "course_count",
        F.col("slots_ts").alias("start_scrape_ts"),
        M.slots_left("slots_message").alias("slots_left"),
        _extraction_text().alias("courses_extracted_ts"),
    )


def dashboard_scraper_performance(t: Tables, stage: bool = False) -> DataFrame:
    """Per source: counts, last run, scrape start, end and duration as text, slots left."""
    return _performance(t, fallback=False, stage=stage).select(
        F.col("cleaned_name").alias("canonical_name"),
        "source_name",
        "url_count",
        "course_count",
        "run_id",
        "run_status",
        times.hyphen_minute_text("start_scrape_ts").alias("start_scrape_ts"),
        times.hyphen_minute_text("scrape_ts").alias("end_scrape_ts"),
        times.clock_duration("start_scrape_ts", "scrape_ts").alias("scrape_time_hh_mm_ss"),
        M.slots_left("slots_message").alias("slots_left"),
        _extraction_text().alias("courses_extracted_date"),
    )


def courses_with_taxonomy(t: Tables) -> DataFrame:
    """Course x taxonomy label with the school's name.

    Labels meet their descriptions on the small taxonomy first; course texts join last.
    """
    labels = lookup_join(
        t.course_taxonomy01.select("course_id", "taxonomy_id"),
        t.taxonomy01.select("taxonomy_id", "taxonomy_description"),
        "taxonomy_id",
    )
    owners = t.courses.select("course_id", F.col("course_source_id").alias("source_id"))
    named = lookup_join(owners, t.sources.select("source_id", "cleaned_name"), "source_id").drop("source_id")
    thin = labels.join(named, "course_id")
    texts = t.courses.select("course_id", "course_title", "course_description")
    return texts.join(thin, "course_id").select(
        "taxonomy_id", "taxonomy_description", "course_title", "course_description", "cleaned_name"
    )
