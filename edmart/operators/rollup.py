"""Partial results of the marts, stored by period and merged when a mart is built.

A mart over all logs needs few of them: the latest rows of each run and source, and the slots messages of runs
that can still be a source's last one. ``needed_logs`` keeps exactly these, whole rows with the columns of ``logs``,
so every mart runs on them unchanged and gives the same rows. What one period needs does not depend on other periods:
a new day costs a pass over that day's logs, and a day loaded again replaces its own rows only. Reducing what is already
reduced changes no result either, so periods can be merged into longer ones.

Courses are reduced to one row per source, batch and digest of their texts, with a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from edmart.functions import messages as M
from edmart.functions.text import row_digest
from edmart.operators.joins import lookup_join

NO_PERIOD = "none"  # rows without a time


def _latest(condition: Column | None = None) -> Column:
    return F.max("log_ts" if condition is None else F.when(condition, F.col("log_ts")))


def needed_logs(logs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``logs`` that any mart can need, within each value of the columns ``by``.

    Kept are all rows at the latest time of a run, of its completion messages (in either spelling of the
    marts) and of its start messages; all rows of a source, whatever their run, at the source's latest time or
    completion; and slots messages, except those of runs older than the source's last completed one.
    Rows without a source belong to no mart and go; rows without a run or a time are kept by the same rules.
    ``by`` columns must not be NULL.
    """
    message = F.col("log_message")
    rows = logs.filter("log_source_id IS NOT NULL").withColumns(
        {"_no_run": F.col("log_run_id").isNull(), "_run": F.coalesce("log_run_id", F.lit(0))}
    )
    source = [*by, "log_source_id"]
    run = [*source, "_no_run", "_run"]
    per_run = rows.groupBy(*run).agg(
        _latest().alias("_any"),
        _latest(M.is_scraped(message)).alias("_done"),
        _latest(M.is_scraped(message, case_insensitive=True)).alias("_done_any_case"),
        _latest(M.is_scrape_start(message)).alias("_start"),
    )
    completed = F.when(F.col("_done").isNotNull() & ~F.col("_no_run"), F.col("_run"))
    per_source = per_run.groupBy(*source).agg(
        F.max("_any").alias("_source_any"),
        F.max("_done").alias("_source_done"),
        F.max("_done_any_case").alias("_source_done_any_case"),
        F.max(completed).alias("_completed"),
    )
    marks = [c for c in (*per_run.columns, *per_source.columns) if c not in run]
    found = lookup_join(rows, per_run.join(per_source, source), run)

    at, same = F.col("log_ts"), F.lit(False)
    for mark in ("_done", "_done_any_case", "_start", "_source_done", "_source_done_any_case"):
        same = same | F.coalesce(at == F.col(mark), F.lit(False))
    for mark in ("_any", "_source_any"):
        same = same | at.eqNullSafe(F.col(mark))
    slots = F.coalesce(M.is_slots(message), F.lit(False)) & ~F.col("_no_run")
    can_be_last = F.col("_completed").isNull() | (F.col("_run") >= F.col("_completed"))
    return found.filter(same | (slots & can_be_last)).drop("_no_run", "_run", *marks).select(*logs.columns)


def period_of(unit: str) -> Column:
    """The first day of the period (``day``, ``week``, ``month``, ``year``) of a log row, as text."""
    return F.coalesce(F.date_format(F.date_trunc(unit, "log_ts"), "yyyy-MM-dd"), F.lit(NO_PERIOD))


def fold_logs(logs: DataFrame, path: str, unit: str = "day") -> None:
    """Reduce each period found in ``logs`` and replace that period in the store at ``path``.

    ``logs`` holds whole periods: all rows of a day that got late ones. Other periods are neither read nor written,
    and the same call again leaves the same rows. A partition filter on the caller's logs keeps the pass to new days.
    """
    kept = needed_logs(logs.withColumn("log_period", period_of(unit)), ["log_period"])
    (
        kept.hint("rebalance", F.col("log_period"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("log_period")
        .parquet(path)
    )


def folded_logs(spark: SparkSession, path: str, logs: DataFrame) -> DataFrame:
    """The stored rows of all periods, with the columns of ``logs``."""
    schema = StructType([*logs.schema.fields, StructField("log_period", StringType())])
    kept = spark.read.schema(schema).parquet(path)
    return kept.select(*logs.columns)


def course_digests(courses: DataFrame) -> DataFrame:
    """(course_source_id, digest, n): courses counted per source and digest of title and description."""
    digest = row_digest("course_title", "course_description").alias("digest")
    return courses.groupBy("course_source_id", digest).agg(F.count("*").alias("n"))


def fold_courses(courses: DataFrame, path: str, batch: str) -> None:
    """Store the digests of one batch of courses; a batch loaded again replaces its own rows only."""
    course_digests(courses).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def folded_courses(spark: SparkSession, path: str) -> DataFrame:
    """The digests of all batches, one row per source and digest; no course text is read."""
    stored = spark.read.schema("course_source_id string, digest string, n bigint, batch string").parquet(path)
    return stored.groupBy("course_source_id", "digest").agg(F.sum("n").alias("n"))
