"""Staging and mart views under their names, for SQL users."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from edmart.operators import match, staging
from edmart.plans import marts
from edmart.sources.tables import Tables

# view -> (tables it reads, how it is built)
VIEWS: dict[str, tuple[tuple[str, ...], Callable[[Tables], DataFrame]]] = {
    "stg_courses": (("courses",), lambda t: staging.stg_courses(t.courses)),
    "stg_logs": (("logs",), lambda t: staging.stg_logs(t.logs)),
    "stg_runs": (("runs",), lambda t: staging.stg_runs(t.runs)),
    "stg_scraper_schemas": (("scraper_schemas",), lambda t: staging.stg_scraper_schemas(t.scraper_schemas)),
    "stg_sources": (("sources",), lambda t: staging.stg_sources(t.sources)),
    "stg_sources_enabled": (("sources",), lambda t: staging.stg_sources_enabled(t.sources)),
    "stg_urls": (("urls",), lambda t: staging.stg_urls(t.urls)),
    "stg_taxonomies": (("taxonomy01",), lambda t: staging.stg_taxonomies(t.taxonomy01)),
    "stg_course_taxonomy": (("course_taxonomy01",), lambda t: staging.stg_course_taxonomy(t.course_taxonomy01)),
    "stg_join_data_sources": (("sources", "universities"), lambda t: match.match_sources(t.sources, t.universities)),
    "source_data_status": (("sources", "scraper_schemas", "urls", "courses"), marts.source_data_status),
    "source_data_status_enabled": (
        ("sources", "scraper_schemas", "urls", "courses"), marts.source_data_status_enabled,
    ),
    "current_progress_summary": (
        ("sources", "scraper_schemas", "urls", "courses", "logs", "runs"), marts.current_progress_summary,
    ),
    "dashboard_data_summary": (
        ("sources", "scraper_schemas", "urls", "courses", "logs", "runs"), marts.dashboard_data_summary,
    ),
    "scraper_performance": (("sources", "urls", "courses", "logs", "runs"), marts.scraper_performance),
    "dashboard_scraper_performance": (
        ("sources", "urls", "courses", "logs", "runs"), marts.dashboard_scraper_performance,
    ),
    "dim_courses_with_details": (
        ("sources", "courses", "course_taxonomy01", "taxonomy01"), marts.courses_with_taxonomy,
    ),
}


def register_views(tables: Tables, names: Iterable[str] | None = None) -> list[str]:
    """Create the views whose tables are given; they are computed when read. Returns their names."""
    wanted = list(VIEWS if names is None else names)
    made = [n for n in wanted if all(t in tables for t in VIEWS[n][0])]
    for name in made:
        VIEWS[name][1](tables).createOrReplaceTempView(name)
    return made
