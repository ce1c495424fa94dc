"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.llm.shared import stored
from edmart.operators.joins import lookup_join


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = lookup_join(both, low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node joins its smaller neighbours, and itself, to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = lookup_join(edges, low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node in ``pairs``; the root is the smallest node reachable.

    Each round is written to the shared folder, so no round depends on an executor.
    The rounds grow with the logarithm of the longest path. Empty pairs give no rows.
    """
    edges = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
