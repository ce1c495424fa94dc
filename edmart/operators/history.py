"""Type-2 history of a table by comparing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.functions.text import concat_nulls_empty, row_digest
from edmart.operators.lineage import cut_if_computed
from edmart.operators.merge import failing, repeated_key


def course_snapshot_rows(details: DataFrame, key: Sequence[str] = ("taxonomy_id", "course_title")) -> DataFrame:
    """Rows of the course detail mart with their history key: the values of ``key``, joined by ``-``.

    The default is the stored key of the data model. Two schools with one title under one label
    share it: add columns such as ``course_id`` to tell them apart. Texts are kept whole.
    """
    return details.select(concat_nulls_empty(*key, sep="-").alias("history_key"), *details.columns)


def start_history(current: DataFrame, now: Column) -> DataFrame:
    """First snapshot: every row is open."""
    return current.withColumns(
        {"valid_from": now.cast("timestamp"), "valid_to": F.lit(None).cast("timestamp")}
    )


def scd2(history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], now: Column) -> DataFrame:
    """History after comparing ``current`` with its open rows.

    A changed row closes the open version and opens a new one; a new key opens a
    version; keys missing from ``current`` stay open. Keys must be unique in
    ``current`` and among the open rows (the job fails otherwise). Closed versions are not shuffled, and
    open and current rows meet in one join on the key. Rows that come out of joins are stored once first, as they are
    read for the join and for the check of their keys.
    """
    now = now.cast("timestamp")
    current = cut_if_computed(current, "history-current")
    history = cut_if_computed(history, "history-stored")
    columns = current.columns
    closed = history.filter("valid_to IS NOT NULL")
    open_rows = history.filter("valid_to IS NULL")
    opened = open_rows.select(F.col(key), F.struct(*history.columns).alias("old"))
    incoming = current.select(F.col(key), F.struct(*columns).alias("new"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))

    def version(side: str, start: Column, end: Column) -> Column:
        fields = [F.col(f"{side}.{c}").cast(history.schema[c].dataType).alias(c) for c in columns]
        return F.struct(*fields, start.alias("valid_from"), end.cast("timestamp").alias("valid_to"))

    still_open = version("old", F.col("old.valid_from"), F.lit(None))
    ended = version("old", F.col("old.valid_from"), now)
    started = version("new", now, F.lit(None))
    versions = (
        F.when(~has_new | (has_old & has_new & same), F.array(still_open))
        .when(has_old, F.array(ended, started))
        .otherwise(F.array(started))
    )
    live = opened.join(incoming, key, "full").select(F.explode(versions).alias("v")).select("v.*")
    out = closed.select(*live.columns).unionByName(live)
    problem = F.coalesce(repeated_key(current, [key], "current rows"), repeated_key(open_rows, [key], "open history"))
    return out.unionByName(failing(current.sparkSession, problem, out))


def from_states(states: DataFrame, key: str, at: str, check_cols: Sequence[str]) -> DataFrame:
    """The history that ``scd2`` gives after one state after the other, from one pass over all of them.

    ``states`` holds the rows of every state, dated by ``at``. A run of states of a key with equal ``check_cols`` is one
    version: it has the other columns of its first state, begins at that date and ends where the next version begins. A key that a
    state lacks keeps its version. Keys must be unique in each state (the job fails otherwise). Only dates and
    digests of a key's states meet; whole rows are then read for the first state of each version.
    """
    marks = states.select(F.col(key), F.struct(F.col(at).cast("timestamp").alias("at"), row_digest(*check_cols).alias("digest")).alias("mark"))
    # as many marks as states
    kept = marks.groupBy(key).agg(F.array_sort(F.collect_list("mark")).alias("marks"))
    dates = F.transform("marks", lambda m: m["at"])
    message = F.concat(F.lit("a state has several rows for key "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    unique = F.when(F.size(F.array_distinct(dates)) == F.size(dates), F.col("marks")).otherwise(F.raise_error(message))
    kept = kept.select(key, unique.alias("marks"))
    first = F.filter(
        "marks", lambda m, i: (i == 0) | ~m["digest"].eqNullSafe(F.get(F.col("marks"), i - 1)["digest"])
    )
    kept = kept.select(key, F.transform(first, lambda m: m["at"]).alias("starts"))
    versions = F.transform(
        "starts", lambda s, i: F.struct(s.alias("valid_from"), F.get(F.col("starts"), i + 1).alias("valid_to"))
    )
    spans = kept.select(F.col(key).alias("_key"), F.explode(versions).alias("v")).select("_key", "v.*")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(at).cast("timestamp") == F.col("valid_from"))
    columns = [c for c in states.columns if c != at]
    return states.join(spans, same).select(*columns, "valid_from", "valid_to")
