"""SimHash near-duplicates: fingerprints, pigeonring candidates, linked components.

Pigeonring: the 64 bits are cut into ``SEGMENTS`` segments on a ring. If two
fingerprints differ in at most ``d`` bits, there is a segment from which every chain of
``l`` consecutive segments differs in at most ``l * d / SEGMENTS`` bits. While that
budget is below 1 the chain must be equal, so this first part of the chain is the join
key; the longer chains are checked before the full Hamming distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.llm.components import components
from edmart.llm.shared import free_names, stored
from edmart.operators.joins import lookup_join

BITS = 64
SEGMENTS = 9
MAX_DIFFERENCE = 2
SHINGLE = 3
SEED = 42
SMALL_BUCKET = 64
BLOCK = 512
_CHUNK = 1 << 16


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """64-bit hash of each run of ``width`` words, of all words where there are fewer; none without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and six spaces only
    if not tokens:
        return np.empty(0, dtype="<u8")
    width = min(width, len(tokens))
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a whole text; 0 for a text without words."""
    hashes = shingle_hashes(text, SHINGLE)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(texts: DataFrame, text: str, out: str) -> DataFrame:
    """``texts`` without the text, with ``out``: the fingerprint as a signed long."""
    kept = [f for f in texts.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out}` bigint"])
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch[text]], dtype=np.uint64).view(np.int64)
            yield batch[names].assign(**{out: values})

    return texts.mapInPandas(run, schema)


def segment_bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(first bit, width) of each segment, widths as even as possible."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def chain_masks(start: int, segments: int = SEGMENTS) -> list[int]:
    """For l = 1..segments the 64-bit mask of the chain of l segments from ``start``."""
    bounds, masks, mask = segment_bounds(segments), [], 0
    for step in range(segments):
        first, width = bounds[(start + step) % segments]
        mask |= ((1 << width) - 1) << first
        masks.append(mask)
    return masks


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def budget(length: int, segments: int, difference: int) -> int:
    return length * difference // segments


def chain_holds(diff: Column, start: Column, segments: int, difference: int) -> Column:
    """Whether every chain from segment ``start`` keeps to its budget, the whole ring included."""
    out = F.lit(False)
    for s in range(segments):
        fits = F.lit(True)
        # checks only where the budget has not grown: the longest chain of each budget
        for length, mask in enumerate(chain_masks(s, segments), 1):
            if length == segments or budget(length + 1, segments, difference) > budget(length, segments, difference):
                fits = fits & (
                    F.bit_count(diff.bitwiseAND(F.lit(signed(mask)))) <= budget(length, segments, difference)
                )
        out = F.when(start == s, fits).otherwise(out)
    return out


def forest(values: np.ndarray, difference: int) -> list[tuple[int, int]]:
    """Index pairs that join all of ``values`` reachable over steps of at most ``difference`` bits."""
    label = np.arange(len(values))
    links = []
    for i in range(1, len(values)):
        near = np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= difference)
        for tree, first in zip(*np.unique(label[near], return_index=True)):
            links.append((i, int(near[first])))
            label[label == tree] = i
    return links


def linked_pairs(
    prints: DataFrame,
    segments: int = SEGMENTS,
    difference: int = MAX_DIFFERENCE,
    small: int = SMALL_BUCKET,
    block: int = BLOCK,
) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within ``difference`` bits.

    Buckets of up to ``small`` fingerprints return all their links. Larger ones are cut
    into blocks by hash; every two blocks meet in a group of bounded size, which returns
    a spanning forest of its links. Nothing is dropped and no group grows with the data.
    """
    lead = max(n for n in range(1, segments) if budget(n, segments, difference) == 0)
    keyed = prints.select(
        "fp",
        F.posexplode(
            F.array(*[F.col("fp").bitwiseAND(F.lit(signed(chain_masks(s, segments)[lead - 1]))) for s in range(segments)])
        ).alias("start", "key"),
    )
    counts = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).filter("n > 1")
    keyed = stored(lookup_join(keyed, counts, ["start", "key"]), "simhash-keys")
    few = keyed.filter(F.col("n") <= small).select("start", "key", "fp")
    other = few.select("start", "key", F.col("fp").alias("other"))
    diff = F.col("fp").bitwiseXOR(F.col("other"))
    pairs = (
        few.join(other, ["start", "key"])
        .filter((F.col("fp") < F.col("other")) & chain_holds(diff, F.col("start"), segments, difference))
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )
    many = keyed.filter(F.col("n") > small)
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), "fp"), blocks).cast("int")
    met = many.select("start", "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("met"))
    met = met.select("start", "key", "fp", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"))

    def join_block(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(rows["fp"].to_numpy(np.int64))
        links = np.array(forest(values.view(np.uint64), difference), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": values[links[:, 0]], "b": values[links[:, 1]]})

    blocked = met.groupBy("start", "key", "low", "high").applyInPandas(join_block, "a long, b long")
    return pairs.unionByName(blocked).distinct()


def _grouped(docs: DataFrame, segments: int, difference: int) -> DataFrame:
    thin = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    prints = stored(fingerprints(thin, "text", "fp"), "simhash-prints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(linked_pairs(first.select("fp"), segments, difference), "a", "b")
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = lookup_join(rooted.select("fp", "root"), smallest, "root")
    return lookup_join(prints, members, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, segments: int = SEGMENTS, difference: int = MAX_DIFFERENCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of at most ``difference``
    bits, NULL only if no linked row has an id. NULL and empty texts have fingerprint 0 and
    link like any other. Repeated rows come back as often as they came in. Other columns
    are not read.
    """
    return _grouped(docs, segments, difference).select("doc_id", "fp", "component_id")


def keep_smallest(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row of ``docs`` per ``root`` of ``grouped`` (doc_id, text_hash, root): that of the smallest doc_id."""
    h, k_id, k_hash = free_names(docs, "_text_hash", "_k_id", "_k_hash")
    first = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    kept = (
        grouped.groupBy("root")
        .agg(first.alias("k"))
        .select(F.col("k.doc_id").alias(k_id), F.col("k.text_hash").alias(k_hash))
    )
    rows = docs.withColumn(h, F.xxhash64("text"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_hash)), "left_semi")
    return rows.dropDuplicates(["doc_id", h]).select(*docs.columns)


def keep_one(docs: DataFrame, segments: int = SEGMENTS, difference: int = MAX_DIFFERENCE) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest doc_id, columns unchanged.

    Of rows that share this doc_id the one with the smallest text hash stays, once. A
    component without any doc_id keeps one row as well.
    """
    return keep_smallest(docs, _grouped(docs, segments, difference))
