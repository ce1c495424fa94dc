"""Point reads and staging views: projections and filters that reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.operators.audit import audit_columns
from edmart.operators.joins import lookup_join


def enabled_sources(sources: DataFrame) -> DataFrame:
    """Enabled sources with the crawl settings under their external names."""
    return sources.filter("is_enabled").select(
        "source_id",
        F.col("source_name").alias("name"),
        F.col("source_type").alias("type"),
        F.col("source_base_url").alias("root_url"),
        F.col("source_schema_url").alias("schema_url"),
        "include_external",
        F.col("source_crawl_depth").alias("crawl_depth"),
        "page_timeout_s",
        "max_concurrency",
        "url_base_exclude",
        "url_exclude_patterns",
    )


def _of_sources(child: DataFrame, key: str, sources: DataFrame, source_id: str | None) -> DataFrame:
    """Rows of ``child`` whose source exists, for one source or for all.

    ``source_id`` is unique in sources, so the membership test equals the inner
    join; as a left-semi join a hot source on the child side can still be split.
    """
    ids = sources.select(F.col("source_id").alias(key))
    if source_id is not None:
        child = child.filter(F.col(key) == source_id)
        ids = ids.filter(F.col(key) == source_id)
    return lookup_join(child, ids, key, "left_semi")


def scraper_schema(schemas: DataFrame, sources: DataFrame, source_id: str | None = None) -> DataFrame:
    """Scraper schema text of one source, or of every source."""
    rows = _of_sources(schemas, "scraper_schema_source_id", sources, source_id)
    return rows.select("scraper_schema_source_id", "scraper_schema_json")


def target_urls(urls: DataFrame, sources: DataFrame, source_id: str | None = None) -> DataFrame:
    """Target links of one source, or of every source."""
    rows = _of_sources(urls.filter("is_target"), "url_source_id", sources, source_id)
    return rows.select("url_source_id", "url_link")


def course_data(courses: DataFrame, sources: DataFrame, source_id: str | None = None) -> DataFrame:
    """Courses of one source, or of every source."""
    return _of_sources(courses, "course_source_id", sources, source_id).select(
        "course_id", "course_code", "course_title", "course_description", "course_credits"
    )


def stg_courses(courses: DataFrame) -> DataFrame:
    return courses.select(
        "course_id", "course_source_id", "course_title", "course_description", "course_code",
        *audit_columns("courses"),
    )


def stg_logs(logs: DataFrame) -> DataFrame:
    return logs.select(
        "log_id", "log_run_id", "log_source_id", "log_stage", "log_message", "log_ts", "logs_crtd_dt"
    )


def stg_runs(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "run_status", "run_start_time", "run_end_time", *audit_columns("runs"))


def stg_scraper_schemas(schemas: DataFrame) -> DataFrame:
    return schemas.select("scraper_schema_id", "scraper_schema_source_id", "scraper_schema_json")


def stg_sources(sources: DataFrame) -> DataFrame:
    return sources.select("source_id", "source_name", "is_enabled", "cleaned_name")


def stg_sources_enabled(sources: DataFrame) -> DataFrame:
    return stg_sources(sources).filter("is_enabled")


def stg_urls(urls: DataFrame) -> DataFrame:
    return urls.select("url_id", "url_source_id", "url_link", "is_target")


def stg_taxonomies(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.select("taxonomy_id", "taxonomy_description")


def stg_course_taxonomy(course_taxonomy: DataFrame) -> DataFrame:
    return course_taxonomy.select("course_id", "taxonomy_id")
