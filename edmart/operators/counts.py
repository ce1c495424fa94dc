"""Counts per source and per school.

Rows are counted per source id first, with map-side combine, and only those
counts meet ``sources``: no fact row is joined, so a source that owns a third of
all rows costs one counter per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.functions.text import row_digest
from edmart.operators.joins import lookup_join


def count_per(df: DataFrame, key: str, name: str) -> DataFrame:
    """``COUNT(*)`` per key."""
    return df.groupBy(key).agg(F.count("*").alias(name))


def _ones(df: DataFrame, key: str, **flags: int) -> DataFrame:
    return df.select(F.col(key).alias("source_id"), *[F.lit(v).cast("bigint").alias(n) for n, v in flags.items()])


def school_counts(sources: DataFrame, schemas: DataFrame, urls: DataFrame) -> DataFrame:
    """Per cleaned name: source, schema and url counts, and whether any source is enabled.

    One pass over the union of the children, one join with the sources, one
    roll-up to names. A NULL name matches nothing, so its child counts are 0.
    """
    per_source = (
        _ones(schemas, "scraper_schema_source_id", schema_count=1, url_count=0)
        .unionByName(_ones(urls, "url_source_id", schema_count=0, url_count=1))
        .groupBy("source_id")
        .agg(F.sum("schema_count").alias("schema_count"), F.sum("url_count").alias("url_count"))
    )
    named = F.col("cleaned_name").isNotNull()
    total = lambda c: F.coalesce(F.sum(F.when(named, c)), F.lit(0))
    return (
        sources.select("source_id", "cleaned_name", "is_enabled")
        .join(per_source, "source_id", "left")
        .groupBy("cleaned_name")
        .agg(
            total(F.lit(1)).cast("bigint").alias("source_count"),
            total(F.col("schema_count")).alias("schema_count"),
            total(F.col("url_count")).alias("url_count"),
            F.max("is_enabled").alias("any_enabled"),
        )
    )


def distinct_course_counts(courses: DataFrame, sources: DataFrame) -> DataFrame:
    """Courses per cleaned name, distinct on (name, description, title), NULLs counting as equal.

    The two texts are digested before any shuffle. Distinct rows are shuffled on
    (name, digest), so one school's courses spread over all tasks.
    """
    digest = row_digest("course_title", "course_description").alias("digest")
    return distinct_digest_counts(courses.select("course_source_id", digest), sources)


def distinct_digest_counts(digests: DataFrame, sources: DataFrame) -> DataFrame:
    """``distinct_course_counts`` from digests (course_source_id, digest) made earlier."""
    owned = digests.select(F.col("course_source_id").alias("source_id"), "digest")
    return (
        lookup_join(owned, sources.select("source_id", "cleaned_name"), "source_id")
        .select("cleaned_name", "digest")
        .distinct()
        .groupBy("cleaned_name")
        .agg(F.count("*").alias("course_count"))
    )
