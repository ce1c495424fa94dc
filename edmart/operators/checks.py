"""Integrity checks. Each returns the violations; an empty result means the table is sound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart import schemas


def check_fk(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of ``child`` without a parent, with their row counts. NULL keys pass.

    Keys are counted before the anti join, so a hot key is one row by then.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULLs count as equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_columns(df: DataFrame, table: schemas.Table) -> DataFrame:
    """Columns with missing required values or texts longer than declared, in one pass."""
    counters, labels = [], []
    for c in table.columns:
        if c.name not in df.columns:
            continue
        if c.required:
            labels.append((c.name, "null"))
            counters.append(F.count_if(F.col(c.name).isNull()))
        if c.length is not None:
            labels.append((c.name, "too long"))
            counters.append(F.count_if(F.length(c.name) > c.length))
    found = F.array(
        *[
            F.struct(F.lit(n).alias("column_name"), F.lit(p).alias("problem"), F.col(f"c{i}").alias("n"))
            for i, (n, p) in enumerate(labels)
        ]
    )
    totals = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters)])
    return totals.select(F.inline(found)).filter("n > 0")


def table_violations(tables, name: str) -> DataFrame:
    """Row counts of every broken rule of one table, against the other tables given."""
    declared, df = schemas.TABLES[name], tables[name]
    parts = [check_columns(df, declared).select(F.col("column_name").alias("subject"), "problem", "n")]
    for keys in (declared.primary_key, *declared.unique):
        repeated = check_unique(df, keys).agg(F.count("*").alias("n")).filter("n > 0")
        parts.append(repeated.select(F.lit(", ".join(keys)).alias("subject"), F.lit("repeated").alias("problem"), "n"))
    for key, (parent, parent_key, _) in declared.foreign_keys.items():
        if parent in tables and key in df.columns:
            orphans = check_fk(df, key, tables[parent], parent_key).agg(F.sum("n").alias("n")).filter("n > 0")
            parts.append(orphans.select(F.lit(key).alias("subject"), F.lit("no parent").alias("problem"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
