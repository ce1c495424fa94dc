"""Yearly survey loads: scan, validate, merge. Nothing is written before the whole batch is valid.

Batch and counters come from one reading of the survey tables: rows are graded once, stored in the
checkpoint folder, and both are derived from that. Metrics of a running job (``observe``) would not do:
they count the tasks of a lost executor twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edmart import schemas
from edmart.operators import merge, validate
from edmart.operators.lineage import cut, cut_if_computed
from edmart.sources.survey import SurveyScan, scan_survey
from edmart.sources.tables import by_partition


class Load(NamedTuple):
    """The merged fact table, the batch merged into it, the counters, and the scan."""

    facts: DataFrame
    batch: DataFrame
    report: DataFrame
    scan: SurveyScan


def _graded_load(
    scan: SurveyScan, universities: DataFrame, columns: Sequence[str], on_duplicate: str
) -> tuple[DataFrame, DataFrame]:
    """Batch and counters of a survey of one label and one measure."""
    graded = cut(validate.graded_measures(scan.rows, universities, columns))
    label, measure = columns
    rows = validate.valid_of_graded(graded, columns)
    batch = validate.combine_duplicates(rows, ["report_year", "unitid", label], measure, on_duplicate)
    return cut_if_computed(batch), validate.report_of_measures(graded)


def load_gradrates(
    spark: SparkSession, directory: str, universities: DataFrame, target: DataFrame,
    on_duplicate: str = "error", **scan_options,
) -> Load:
    return merge_gradrates(scan_survey(spark, directory, "GR", **scan_options), universities, target, on_duplicate)


def merge_gradrates(scan: SurveyScan, universities: DataFrame, target: DataFrame, on_duplicate: str = "error") -> Load:
    batch, report = _graded_load(scan, universities, ["grtype", "grtotlt"], on_duplicate)
    return Load(merge.upsert_gradrates(target, batch), batch, report, scan)


def load_enrollment(
    spark: SparkSession, directory: str, universities: DataFrame, target: DataFrame,
    on_duplicate: str = "error", **scan_options,
) -> Load:
    return merge_enrollment(scan_survey(spark, directory, "EFFY", **scan_options), universities, target, on_duplicate)


def merge_enrollment(scan: SurveyScan, universities: DataFrame, target: DataFrame, on_duplicate: str = "error") -> Load:
    batch, report = _graded_load(scan, universities, ["student_level", "total_headcount"], on_duplicate)
    return Load(merge.upsert_enrollment(target, batch), batch, report, scan)


def load_completions(
    spark: SparkSession, directory: str, universities: DataFrame, programs: DataFrame, target: DataFrame,
    **scan_options,
) -> Load:
    """Duplicate keys are always summed here."""
    return merge_completions(scan_survey(spark, directory, "C_A", **scan_options), universities, programs, target)


def merge_completions(scan: SurveyScan, universities: DataFrame, programs: DataFrame, target: DataFrame) -> Load:
    graded = cut(validate.graded_completions(scan.rows, universities, programs))
    batch, report = cut(validate.batch_of_graded(graded)), validate.report_of_graded(graded)
    return Load(merge.upsert_completions(target, batch), batch, report, scan)


def fact_id(table: schemas.Table) -> Column:
    """A fact's id from its natural key: the same on every run, and no stored id has to be read."""
    return F.xxhash64(*[F.col(c).cast(table.struct[c].dataType) for c in table.merge_key])


def unlisted_year(batch: DataFrame, years: Sequence[int]) -> Column:
    """A message about a batch row of another report year, or of none; NULL if there is none."""
    listed = F.coalesce(F.col("report_year").isin(*years), F.lit(False)) if years else F.lit(False)
    year = F.coalesce(F.col("report_year").cast("string"), F.lit("NULL"))
    message = F.concat(F.lit("batch row of an unlisted report year: "), year)
    return batch.filter(~listed).limit(1).select(message.alias("problem")).scalar()


def upsert_years(
    spark: SparkSession,
    path: str,
    table: schemas.Table,
    upsert: Callable[..., DataFrame],
    batch: DataFrame,
    years: Sequence[int],
    **options,
) -> None:
    """Merge a batch into a stored fact table, reading and rewriting only its report years.

    The year is part of every fact key, so other years cannot match: their
    partitions are neither scanned (partition pruning) nor written (dynamic
    overwrite). ``years`` comes from the survey table names; a batch row of any other
    year fails the job before anything is written. Partitions are replaced one after the other at
    commit: a driver that dies then leaves some years new and some old, and the load
    has to run again, which gives the same rows and ids.
    """
    stored = spark.read.schema(table.struct).parquet(path)
    touched = stored.filter(F.col("report_year").isin(*years))
    defaults = {table.primary_key[0]: fact_id(table)}
    merged = upsert(touched, batch, defaults=defaults, **options)
    merged = merged.unionByName(merge.failing(spark, unlisted_year(batch, years), merged))
    (
        by_partition(merged, table)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*table.partition_by)
        .parquet(path)
    )
