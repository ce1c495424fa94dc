"""Joins of rows with hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join ``rows``, where one key may own a third of all rows, with a lookup of few rows per key.

    A small lookup is broadcast by its measured size and nothing is shuffled. Beyond
    that size adaptive execution splits the hot partitions of ``rows``, but only if
    both inputs are plain shuffles: a lookup that was just aggregated by the same
    key is already partitioned, which switches the splitting off. The hash of the
    key as a second join column asks for one more shuffle of the lookup and so
    keeps the splitting possible. It never changes which rows match.

    A NULL key matches nothing but stays in left and anti joins. ``spread`` names
    columns of ``rows`` whose hash takes the place of the key's hash for such rows,
    so that they are not all sent to one task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    tag = F.xxhash64(*keys)
    left_tag = tag
    if spread:
        no_key = reduce(or_, [F.col(k).isNull() for k in keys])
        left_tag = F.when(no_key, F.xxhash64(*spread)).otherwise(tag)
    left = rows.withColumn("_key_hash", left_tag)
    right = lookup.withColumn("_key_hash", tag)
    return left.join(right, [*keys, "_key_hash"], how).drop("_key_hash")
