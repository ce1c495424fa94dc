"""Shards along a Hilbert curve through several metadata columns.

Each dimension is quantised at its own quantiles, the cell's index on the Hilbert curve
orders the rows, and the ordered rows are cut into shards and files of even row counts.
Neighbours on the curve are close in every dimension, so a file covers a small range of
each and a reader prunes files by the minima and maxima in ``manifest``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from edmart.llm.shared import free_names, shared_folder, stored

SHARDS = 8
BITS = 4
FILE_ROWS = 100_000
SAMPLE = 4096  # different texts that the cut points of a text column come from
ADDED = ("hilbert", "shard", "slot", "file")


def order_code(df: DataFrame, name: str) -> Column:
    """The column as something that is compared in its order: numbers rounded down, else the whole text."""
    if isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType)):
        return F.col(name).cast("long")
    return F.col(name).cast("string")


def quantile_cuts(codes: DataFrame, bits: int, sample: int = SAMPLE) -> dict[str, list]:
    """At most ``2**bits - 1`` rising cut points per column.

    Those of numbers come from one approximate quantile pass over all rows, those of texts from the counts of
    ``sample`` different values, the ones of the lowest hash: whole texts are compared, however long their common
    beginning is.
    """
    parts = [i / 2**bits for i in range(1, 2**bits)]
    numbers = [f.name for f in codes.schema.fields if f.dataType == T.LongType()]
    texts = [c for c in codes.columns if c not in numbers]
    cuts: dict[str, list] = {}
    if numbers:
        row = codes.agg(*[F.percentile_approx(c, parts, 10_000).alias(c) for c in numbers]).first()
        cuts |= {c: sorted(set(row[c] or [])) for c in numbers}
    for c in texts:
        counts = codes.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        rows = counts.orderBy(F.xxhash64(c), c).limit(sample).collect()
        values = sorted(((r[0], r[1]) for r in rows), key=lambda v: v[0].encode("utf-8"))
        total, at, found = sum(n for _, n in values), 0, []
        wanted = [p * total for p in parts]
        for text, n in values:
            at += n
            if wanted and at > wanted[0]:
                found.append(text)
                wanted = [w for w in wanted if w >= at]
        cuts[c] = found
    return cuts


def cell_of(code: Column, cuts: list) -> Column:
    """How many cut points are below the value; 0 for NULL."""
    return sum((F.coalesce(code > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The position on the Hilbert curve of each row of ``cells`` (rows x dimensions, ``bits`` bits each)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:  # undo the rotations, from the coarsest level down
        low = level - 1
        for i in range(dims):
            far = (x[i] & level) != 0
            swap = np.where(far, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(far, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[dims - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def with_hilbert(df: DataFrame, dims: list[str], bits: int = BITS, out: str = "hilbert") -> DataFrame:
    """``df`` with the curve index of its cell in the quantised ``dims``."""
    if bits * len(dims) > 62:
        raise ValueError("the index has at most 62 bits")
    cuts = quantile_cuts(df.select(*[order_code(df, d).alias(d) for d in dims]), bits)

    @F.pandas_udf("long")
    def index(*cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack(cells), bits))

    return df.withColumn(out, index(*[cell_of(order_code(df, d), cuts[d]) for d in dims]))


def assign_shards(
    df: DataFrame,
    dims: list[str],
    ties: list[str],
    shards: int = SHARDS,
    bits: int = BITS,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """``df`` with ``hilbert``, ``shard``, ``slot`` (gapless from 0 in the shard) and ``file`` of every row.

    Rows are ranked by curve index, then by ``ties``; shard sizes differ by one row at most.
    NULL dimensions count as the lowest cell. Rows equal in index and ties take neighbouring
    slots in any order. An empty table stays empty. A column of ``df`` with one of the four
    names keeps its values under that name with an underscore behind it (or more, until it is free).
    """
    for name in df.columns:
        if name.lower() in ADDED:
            (free,) = free_names(df, f"{name}_")
            df = df.withColumnRenamed(name, free)
            dims, ties = ([free if c.lower() == name.lower() else c for c in own] for own in (dims, ties))
    p, r = free_names(df, "_part", "_rank")
    order = ["hilbert", *ties]
    # a range exchange, then the sorted partitions as they are, written once: ranks need fixed partitions
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = with_hilbert(df, dims, bits).repartitionByRange(parts, *order).withColumn(p, F.spark_partition_id())
    ranged = stored(ranged, "hilbert")
    counts = sorted((row[0], row[1]) for row in ranged.groupBy(p).agg(F.count("*")).collect())
    total, before, offsets = sum(n for _, n in counts), 0, []
    for part, n in counts:
        offsets.append((part, before))
        before += n
    offset = F.lit(0)
    if offsets:
        by_part = F.create_map(*[F.lit(v).cast("long") for pair in offsets for v in pair])
        offset = F.element_at(by_part, F.col(p).cast("long"))
    in_part = F.row_number().over(Window.partitionBy(p).orderBy(*order)) - 1
    base, more = divmod(total, shards)
    rank, wide = F.col(r), more * (base + 1)  # the first ``more`` shards have one row more
    shard = F.when(rank < wide, F.floor(rank / (base + 1))).otherwise(more + F.floor((rank - wide) / max(base, 1)))
    start = F.col("shard") * base + F.least(F.col("shard"), F.lit(more))
    ranked = ranged.withColumn(r, offset + in_part).withColumn("shard", shard.cast("int"))
    ranked = ranked.withColumn("slot", (rank - start).cast("long"))
    return ranked.withColumn("file", F.floor(F.col("slot") / file_rows).cast("int")).drop(p, r)


def manifest(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Rows, minimum and maximum of each dimension per (shard, file), for pruning."""
    ranges = [f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard", "file").agg(F.count("*").alias("n_rows"), *ranges)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Parquet folders by shard and file, sorted by slot, each written by one task."""
    n = max(1, int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = sharded.repartition(n, "shard", "file").sortWithinPartitions("shard", "file", "slot")
    dealt.write.partitionBy("shard", "file").parquet(path)


def write_and_list(sharded: DataFrame, dims: list[str]) -> tuple[str, DataFrame]:
    """A new folder of shards in the shared folder, and its manifest."""
    path = f"{shared_folder(sharded.sparkSession)}/shards-{uuid.uuid4().hex}"
    write_shards(sharded, path)
    return path, manifest(sharded.sparkSession.read.parquet(path), dims)
