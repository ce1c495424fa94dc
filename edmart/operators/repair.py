"""Program-code repair, keep-one dedupe, orphan removal, run closing and cascading delete."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart import schemas
from edmart.functions import cip
from edmart.operators.joins import lookup_join


def repair_cip(df: DataFrame, column: str = "cipcode") -> DataFrame:
    """Text codes as decimals; unreadable and missing codes become 0.0000."""
    return df.withColumn(column, F.coalesce(cip.repaired_cip(column), F.lit(0).cast(cip.CIP_TYPE)))


def dedupe_programs(programs: DataFrame, column: str = "cipcode") -> DataFrame:
    """One program per repaired code; unreadable and missing codes form one group.

    The reference order is arbitrary; here the smallest original code wins, then
    the smallest remaining columns. Missing codes come out as NULL (see ``repair_cip``).
    A minimum per code combines map-side, so the group of unreadable codes may be
    of any size.
    """
    rest = [c for c in programs.columns if c != column]
    best = F.min(F.struct(F.col(column).alias("original"), *rest)).alias("best")
    return (
        programs.groupBy(cip.repaired_cip(column).alias("code"))
        .agg(best)
        .select(F.col("code").alias(column), *[F.col(f"best.{c}").alias(c) for c in rest])
        .select(*programs.columns)
    )


def drop_orphans(facts: DataFrame, programs: DataFrame, column: str = "cipcode") -> DataFrame:
    """Facts whose code is a program, and facts without a code.

    One pass over the facts: a semi join would lose the NULL codes and ask for a second.
    """
    codes = programs.select(column).distinct().withColumn("_known", F.lit(True))
    marked = lookup_join(facts, codes, column, "left", facts.columns)
    return marked.filter(F.col("_known").isNotNull() | F.col(column).isNull()).select(*facts.columns)


def repair_programs_and_facts(programs: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole repair: clean, dedupe programs, drop orphan facts, fill missing codes."""
    zero = F.lit(0).cast(cip.CIP_TYPE)
    kept_programs = dedupe_programs(programs)
    cleaned = facts.withColumn("cipcode", cip.repaired_cip("cipcode"))
    kept_facts = drop_orphans(cleaned, kept_programs)
    fill = lambda df: df.withColumn("cipcode", F.coalesce("cipcode", zero))
    return fill(kept_programs), fill(kept_facts)


def close_runs(runs: DataFrame, ids: DataFrame, now: Column | None = None) -> DataFrame:
    """Mark the runs in ``ids`` (column run_id) finished at ``now``."""
    closing = ids.select("run_id").distinct().withColumn("_closing", F.lit(True))
    hit = F.col("_closing").isNotNull()
    end = now if now is not None else F.current_timestamp()
    return (
        runs.join(closing, "run_id", "left")
        .withColumn("run_status", F.when(hit, "finished").otherwise(F.col("run_status")))
        .withColumn("run_end_time", F.when(hit, end).otherwise(F.col("run_end_time")))
        .select(*runs.columns)
    )


def _children(root: str):
    """(child table, its key, root key, cascades) for every declared reference to ``root``."""
    for child in schemas.TABLES.values():
        for key, (parent, parent_key, cascades) in child.foreign_keys.items():
            if parent == root:
                yield child.name, key, parent_key, cascades


def delete_cascade(tables: Mapping[str, DataFrame], root: str, ids: DataFrame) -> dict[str, DataFrame]:
    """Tables after deleting the rows of ``root`` in ``ids`` and the rows that go with them.

    Rows of children that do not cascade forbid the delete: see ``delete_blockers``.
    """
    root_key = schemas.TABLES[root].primary_key[0]
    out = dict(tables)
    gone = ids.select(root_key)
    out[root] = tables[root].join(gone, root_key, "left_anti").select(*tables[root].columns)
    for child, key, parent_key, cascades in _children(root):
        if cascades and child in tables:
            keys = gone.select(F.col(parent_key).alias(key))
            own_key = schemas.TABLES[child].primary_key
            left = lookup_join(tables[child], keys, key, "left_anti", own_key)
            out[child] = left.select(*tables[child].columns)
    return out


def delete_blockers(tables: Mapping[str, DataFrame], root: str, ids: DataFrame) -> DataFrame:
    """Per table and id, the rows that forbid deleting ``ids`` from ``root``."""
    root_key = schemas.TABLES[root].primary_key[0]
    gone = ids.select(F.col(root_key).alias("id")).distinct()
    out = gone.select(F.lit("").alias("table_name"), "id", F.lit(0).cast("bigint").alias("n")).filter(F.lit(False))
    for child, key, _, cascades in _children(root):
        if not cascades and child in tables:
            used = tables[child].groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
            out = out.unionByName(
                used.join(gone, "id", "left_semi").select(F.lit(child).alias("table_name"), "id", "n")
            )
    return out
