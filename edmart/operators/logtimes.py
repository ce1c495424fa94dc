"""Latest log rows and independent maxima, as aggregates with map-side combine.

A window per school would send all rows of a school to one task; the maximum of
a struct sends one row per school and task, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.functions import messages as M
from edmart.operators.joins import lookup_join


def _newest_per_source(logs: DataFrame, *payload: str) -> DataFrame:
    """(source_id, row): the newest log row of each source; equal times are decided by the larger log id.

    The greatest time comes first, as a hash aggregate without texts. Only the rows of that
    time are compared as structs, so no full pass over the logs is sorted.
    """
    key = F.col("log_source_id").alias("source_id")
    last = logs.groupBy(key).agg(F.max("log_ts").alias("last_ts"))
    rows = logs.select(key, F.struct("log_ts", "log_id", *payload).alias("row"))
    at_last = lookup_join(rows, last, "source_id").filter(F.col("row.log_ts").eqNullSafe(F.col("last_ts")))
    return at_last.groupBy("source_id").agg(F.max("row").alias("row"))


def _newest_per_school(logs: DataFrame, sources: DataFrame, *payload: str) -> DataFrame:
    """The newest row per cleaned name."""
    return (
        _newest_per_source(logs, *payload)
        .join(sources.select("source_id", "cleaned_name"), "source_id")
        .groupBy(F.col("cleaned_name").alias("school_name"))
        .agg(F.max("row").alias("row"))
        .select("school_name", "row.*")
    )


def latest_scrape(logs: DataFrame, sources: DataFrame) -> DataFrame:
    """Newest completion message per school."""
    done = logs.filter(M.is_scraped("log_message", case_insensitive=True))
    return _newest_per_school(done, sources, "log_message").select(
        "school_name",
        F.col("log_ts").alias("last_scrape_ts"),
        F.col("log_message").alias("scraped_log_message"),
    )


def latest_log(logs: DataFrame, sources: DataFrame) -> DataFrame:
    """Newest log row of any kind per school."""
    return _newest_per_school(logs, sources, "log_message", "log_run_id").select(
        "school_name", F.col("log_message").alias("latest_log_message"), "log_run_id"
    )


def school_log_summary(logs: DataFrame, sources: DataFrame) -> DataFrame:
    """Both of the above per school: latest message and run, and the latest completion time."""
    done = M.is_scraped("log_message", case_insensitive=True)
    scraped = logs.groupBy(F.col("log_source_id").alias("source_id")).agg(
        F.max(F.when(done, F.col("log_ts"))).alias("scraped_ts")
    )
    newest = _newest_per_source(logs, "log_message", "log_run_id").withColumnRenamed("row", "newest")
    per_source = newest.join(scraped, "source_id")
    return (
        per_source.join(sources.select("source_id", "cleaned_name"), "source_id")
        .groupBy(F.col("cleaned_name").alias("school_name"))
        .agg(F.max("newest").alias("newest"), F.max("scraped_ts").alias("last_scrape_ts"))
        .select(
            "school_name",
            "last_scrape_ts",
            F.col("newest.log_message").alias("latest_log_message"),
            F.col("newest.log_run_id").alias("log_run_id"),
        )
    )


def scrape_times(sources: DataFrame, logs: DataFrame, fallback: bool) -> DataFrame:
    """Per source, from one pass over the logs: completion time and run, and start time.

    ``scrape_ts`` and ``max_run_id`` are independent maxima and may come from
    different rows. With ``fallback`` a source without a completion message takes
    each of them from all of its log rows. ``slots_rows`` tells how many
    slots-left messages the run ``max_run_id`` of the source has.
    """
    per_run = logs.groupBy("log_source_id", "log_run_id").agg(
        F.max(F.when(M.is_scraped("log_message"), F.col("log_ts"))).alias("scraped_ts"),
        F.max("log_ts").alias("any_ts"),
        F.max(F.when(M.is_scrape_start("log_message"), F.col("log_ts"))).alias("start_ts"),
        F.count_if(M.is_slots("log_message")).alias("slots_rows"),
    )
    scraped_run = F.when(F.col("scraped_ts").isNotNull(), F.col("log_run_id"))
    per_source = per_run.groupBy(F.col("log_source_id").alias("source_id")).agg(
        F.max("scraped_ts").alias("scraped_ts"),
        F.max(scraped_run).alias("scraped_run"),
        F.max_by("slots_rows", scraped_run).alias("scraped_slots"),
        F.max("any_ts").alias("any_ts"),
        F.max("log_run_id").alias("any_run"),
        F.max_by("slots_rows", "log_run_id").alias("any_slots"),
        F.max("start_ts").alias("start_ts"),
    )
    ts, run, slots = F.col("scraped_ts"), F.col("scraped_run"), F.col("scraped_slots")
    if fallback:
        slots = F.when(run.isNotNull(), slots).otherwise(F.col("any_slots"))
        ts, run = F.coalesce(ts, F.col("any_ts")), F.coalesce(run, F.col("any_run"))
    return (
        sources.select("source_id")
        .join(per_source, "source_id", "left")
        .select(
            "source_id",
            ts.alias("scrape_ts"),
            run.alias("max_run_id"),
            F.col("start_ts").alias("start_scrape_ts"),
            F.coalesce(slots, F.lit(0)).alias("slots_rows"),
        )
    )


def scrape_complete(sources: DataFrame, logs: DataFrame, fallback: bool = True) -> DataFrame:
    """Latest completion per source; every source is kept."""
    return scrape_times(sources, logs, fallback).select("source_id", "scrape_ts", "max_run_id")


def scrape_start(sources: DataFrame, logs: DataFrame) -> DataFrame:
    """Latest scrape start per source; every source is kept."""
    return scrape_times(sources, logs, fallback=False).select(
        "source_id", F.col("start_scrape_ts").alias("scrape_ts")
    )
