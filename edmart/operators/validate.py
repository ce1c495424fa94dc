"""Row validity of survey rows, aggregation before the merge, and load counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.functions import cip
from edmart.operators.joins import lookup_join

# Award levels that are loaded.
AWARD_LEVELS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 17, 18, 19, 20, 21)

COMPLETION_KEYS = ["report_year", "unitid", "cipcode", "award_level"]


def _known_units(rows: DataFrame, universities: DataFrame) -> DataFrame:
    return lookup_join(rows, universities.select("unitid"), "unitid", "left_semi")


def _known_codes(rows: DataFrame, programs: DataFrame) -> DataFrame:
    """Rows whose exact code is a program. Codes widen to the exact type on both sides."""
    codes = programs.select(F.col("cipcode").cast(cip.CIP_EXACT_TYPE).alias("cipcode"))
    return lookup_join(rows, codes, "cipcode", "left_semi")


def _is_measurable() -> Column:
    """Loaded award level and a count; the tests that need no other table."""
    return F.col("award_level").isin(*AWARD_LEVELS) & (F.col("total_completions") >= 0)


def _with_exact_code(rows: DataFrame) -> DataFrame:
    return rows.withColumn("cipcode", cip.exact_cip("cipcode"))


def valid_completions(rows: DataFrame, universities: DataFrame, programs: DataFrame) -> DataFrame:
    """Completions rows with known university, known code, loaded award level and a count."""
    measurable = _with_exact_code(rows.filter(_is_measurable()))
    kept = _known_codes(_known_units(measurable, universities), programs)
    return kept.select(
        "report_year", "unitid", F.col("cipcode").cast(cip.CIP_TYPE).alias("cipcode"),
        "award_level", "total_completions",
    )


def aggregate_completions(rows: DataFrame) -> DataFrame:
    """Sum of completions per key."""
    return rows.groupBy(*COMPLETION_KEYS).agg(F.sum("total_completions").alias("total_completions"))


def completions_batch(rows: DataFrame, universities: DataFrame, programs: DataFrame) -> DataFrame:
    """``aggregate_completions(valid_completions(...))`` with the sums taken first.

    Validity by university and code depends on the key alone, so the rows collapse
    to keys (map-side, whatever one university's share is) before the two joins.
    The first sums keep the code as written; only distinct spellings are parsed, and
    spellings of one code meet in the second sums.
    """
    sums = aggregate_completions(rows.filter(_is_measurable()).select(*COMPLETION_KEYS, "total_completions"))
    kept = _known_codes(_known_units(_with_exact_code(sums), universities), programs)
    return aggregate_completions(kept.withColumn("cipcode", F.col("cipcode").cast(cip.CIP_TYPE)))


def _valid_measures(rows: DataFrame, universities: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = rows.select("report_year", "unitid", *columns).dropna(subset=list(columns))
    return _known_units(present, universities).select("report_year", "unitid", *columns)


def valid_gradrates(rows: DataFrame, universities: DataFrame) -> DataFrame:
    return _valid_measures(rows, universities, ["grtype", "grtotlt"])


def valid_enrollment(rows: DataFrame, universities: DataFrame) -> DataFrame:
    return _valid_measures(rows, universities, ["student_level", "total_headcount"])


def combine_duplicates(rows: DataFrame, keys: Sequence[str], measure: str, on_duplicate: str) -> DataFrame:
    """``"error"`` leaves repeated keys to fail in the merge, ``"sum"`` adds them up."""
    if on_duplicate == "error":
        return rows
    if on_duplicate == "sum":
        return rows.groupBy(*keys).agg(F.sum(measure).alias(measure))
    raise ValueError("on_duplicate is 'error' or 'sum'")


def _report(rows: DataFrame, extracted: Column, skipped: Column) -> DataFrame:
    """Counters per table and year; ``extracted`` and ``skipped`` are the rows that one row of ``rows`` stands for."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rows.groupBy("table_name", "report_year").agg(
        total(extracted).alias("extracted"), total(skipped).alias("skipped")
    )


def _mark_known(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    known = keys.select(key).distinct().withColumn(flag, F.lit(True))
    return rows.join(known, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def graded_completions(rows: DataFrame, universities: DataFrame, programs: DataFrame) -> DataFrame:
    """All rows of the scan summed per table and key, with what the batch and the counters both need.

    ``n`` rows, ``n_measurable`` of them with a loaded level and a count, the sum of those, and whether
    unit and code are known. Rows collapse to keys, code as written, before any code is parsed or joined.
    """
    measurable = F.coalesce(_is_measurable(), F.lit(False))
    sums = rows.groupBy("table_name", *COMPLETION_KEYS).agg(
        F.count("*").alias("n"),
        F.count_if(measurable).alias("n_measurable"),
        F.sum(F.when(measurable, F.col("total_completions"))).alias("total_completions"),
    )
    codes = programs.select(F.col("cipcode").cast(cip.CIP_EXACT_TYPE).alias("cipcode"))
    marked = _mark_known(_with_exact_code(sums), universities, "unitid", "unit_ok")
    return _mark_known(marked, codes, "cipcode", "code_ok")


def batch_of_graded(graded: DataFrame) -> DataFrame:
    """The batch ``completions_batch`` gives, from ``graded_completions``."""
    good = graded.filter(F.col("unit_ok") & F.col("code_ok") & (F.col("n_measurable") > 0))
    return aggregate_completions(good.withColumn("cipcode", F.col("cipcode").cast(cip.CIP_TYPE)))


def report_of_graded(graded: DataFrame) -> DataFrame:
    """Extracted and skipped rows per table, from ``graded_completions``."""
    extracted = F.when(F.col("unit_ok") & F.col("code_ok"), F.col("n_measurable")).otherwise(F.lit(0))
    return _report(graded, extracted, F.col("n") - extracted)


def completions_report(rows: DataFrame, universities: DataFrame, programs: DataFrame) -> DataFrame:
    """Extracted and skipped rows per table; every rejected row counts as skipped."""
    return report_of_graded(graded_completions(rows, universities, programs))


def graded_measures(rows: DataFrame, universities: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All rows of the scan with ``present``, ``unreadable`` and ``unit_ok``, for the batch and the counters."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    unreadable = F.col("unreadable") if "unreadable" in rows.columns else F.lit(False)
    flagged = rows.select(
        "table_name", "report_year", "unitid", *columns, present.alias("present"), unreadable.alias("unreadable")
    )
    known = universities.select("unitid").distinct().withColumn("unit_ok", F.lit(True))
    marked = lookup_join(flagged, known, "unitid", "left", spread=columns)
    return marked.withColumn("unit_ok", F.coalesce("unit_ok", F.lit(False)))


def valid_of_graded(graded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows ``valid_gradrates`` or ``valid_enrollment`` give, from ``graded_measures``."""
    return graded.filter(F.col("unit_ok") & F.col("present")).select("report_year", "unitid", *columns)


def report_of_measures(graded: DataFrame) -> DataFrame:
    """Counters of ``measures_report``, from ``graded_measures``."""
    one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
    unit_ok = F.col("unit_ok")
    return _report(graded, one(unit_ok & F.col("present")), one(~unit_ok | F.col("unreadable")))


def measures_report(rows: DataFrame, universities: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Extracted and skipped rows per table for graduation rates and enrollment.

    Skipped are rows with an unknown university or an unreadable value; rows of a
    known university with a missing measure are counted nowhere.
    """
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    unreadable = F.col("unreadable") if "unreadable" in rows.columns else F.lit(False)
    counted = (
        rows.select("table_name", "report_year", "unitid", present.alias("present"), unreadable.alias("unreadable"))
        .groupBy("table_name", "report_year", "unitid", "present", "unreadable")
        .agg(F.count("*").alias("n"))
    )
    marked = _mark_known(counted, universities, "unitid", "unit_ok")
    n = lambda c: F.when(c, F.col("n")).otherwise(F.lit(0))
    unit_ok = F.col("unit_ok")
    return _report(marked, n(unit_ok & F.col("present")), n(~unit_ok | F.col("unreadable")))
