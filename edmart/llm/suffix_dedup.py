"""Exact removal of repeated 200-byte strings over a whole corpus, by sorted suffixes.

Every window of ``LENGTH`` bytes gets the smallest hash of the short grams inside it.
Consecutive windows with one such key form a piece, so equal windows lie in pieces of
equal key. Keys that occur once are left; pieces that are equal as a whole are
resolved by counting. The different pieces of one key go to one shard, whose suffixes
are ordered by external induced sorting (``induced_sort``): neighbours that share
``LENGTH`` bytes are repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.llm import induced_sort
from edmart.llm.shared import discard, free_names, stored
from edmart.operators.joins import lookup_join

LENGTH = 200
GRAM = 24
SHARD_BYTES = 2 * 1024 * 1024
HOT_BYTES = 512 * 1024  # of different pieces of one key; beyond, its windows are counted one by one
CHUNK = 4_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n of the base, and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed rolling hash of each run of ``gram`` bytes."""
    n = len(data)
    up, down = powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * up[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    full = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    full[: len(values)] = values
    grid = full.reshape(blocks, width)
    front = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], front[width - 1 : width - 1 + n])


def pieces_of(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, size, inner) of the pieces of one text; none if it is shorter than ``length``.

    ``inner``: the piece may repeat a window inside itself, as its key occurs there twice.
    """
    if len(data) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(bool)
    width = length - gram + 1
    grams = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram)
    keys = sliding_minimum(grams, width)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    ends = np.append(starts[1:], len(keys))
    # a gram is the minimum of some window if the largest minimum of its windows is its own hash
    around = np.zeros(len(keys) + 2 * width - 2, dtype=np.uint64)
    around[width - 1 : width - 1 + len(keys)] = keys
    least = grams[grams == ~sliding_minimum(~around, width)]
    again = least[1:][least[1:] == least[:-1]]
    return keys[starts].view(np.int64), starts, ends - starts + length - 1, np.isin(keys[starts], again)


def identified(docs: DataFrame) -> DataFrame:
    """(d1, d2, text): 128 bits of hash of the id and text stand for a row; equal rows share them."""
    return docs.select(F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("d2"), "text")


def pieces(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, content, d1, d2, start, size, inner) of the pieces of all texts."""

    def run(batches):
        for batch in batches:
            parts, n = [], 0
            for d1, d2, text in zip(batch["d1"], batch["d2"], batch["text"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                key, start, size, inner = pieces_of(data, length, gram)
                if len(key):
                    content = [
                        xxhash.xxh3_64_intdigest(data[a : a + b]) for a, b in zip(start.tolist(), size.tolist())
                    ]
                    content = np.array(content, dtype=np.uint64).view(np.int64)
                    parts.append((key, content, np.full(len(key), d1), np.full(len(key), d2), start, size, inner))
                    n += len(data)
                if n > CHUNK:
                    yield frame(parts)
                    parts, n = [], 0
            if parts:
                yield frame(parts)

    def frame(parts):
        names = ["key", "content", "d1", "d2", "start", "size", "inner"]
        return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(names)})

    return rows.mapInPandas(run, "key long, content long, d1 long, d2 long, start int, size int, inner boolean")


def repeats_in_shard(found: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    """(key, content, start, end) of the repeated runs inside the pieces of one shard."""
    if not found:
        return []
    sizes = np.array([len(p[2]) for p in found], dtype=np.int64)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(int(sizes.sum()) + len(found), dtype=np.int16)
    body = np.ones(len(text), dtype=bool)
    body[first + sizes] = False
    text[body] = np.frombuffer(b"".join(p[2] for p in found), dtype=np.uint8).astype(np.int16) + 1
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    last = None
    for suffix, prefix in induced_sort.sorted_suffixes(text, length):
        at = np.flatnonzero(prefix >= length)
        before = np.where(at > 0, suffix[at - 1], last if last is not None else -1)
        both = np.concatenate([suffix[at], before])
        # a prefix that runs over the end of a piece is no window
        owner = np.searchsorted(first, both, side="right") - 1
        both = np.unique(both[both + length <= first[owner] + sizes[owner]])
        edge[both] += 1
        last = int(suffix[-1])
    starts = np.flatnonzero(edge)
    if not len(starts):
        return []
    owner = np.searchsorted(first, starts, side="right") - 1
    new = np.append(True, (np.diff(starts) > length) | (np.diff(owner) != 0))
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(starts)) - 1
    own = owner[heads]
    a, b = starts[heads] - first[own], starts[tails] - first[own] + length
    return [(*found[k][:2], int(x), int(y)) for k, x, y in zip(own.tolist(), a, b)]


def shard_spans(candidates: DataFrame, total_bytes: int, length: int, shard_bytes: int) -> DataFrame:
    """(key, content, s, e) from (key, content, data): each task sorts the suffixes of one shard."""

    def run(batches):
        seen: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            for key, content, data in zip(batch["key"], batch["content"], batch["data"]):
                seen.setdefault((key, content), data)  # equal rows bring a piece again
        spans = repeats_in_shard([(*k, data) for k, data in seen.items()], length)
        yield pd.DataFrame(spans, columns=["key", "content", "s", "e"])

    shards = max(1, -(-total_bytes // shard_bytes))
    return candidates.repartition(shards, "key").mapInPandas(run, "key long, content long, s int, e int")


def hot_spans(candidates: DataFrame, length: int) -> DataFrame:
    """The same for keys with very many bytes: equal windows are counted, in no order and no group.

    128 bits of hash stand for a window.
    """
    starts = F.sequence(F.lit(0), F.length("data") - length)
    # equal rows bring a piece again
    pieces = candidates.dropDuplicates(["key", "content"])
    each = pieces.select("key", "content", "data", F.explode(starts).alias("s"))
    window = F.expr(f"substring(data, s + 1, {length})")
    each = each.select("key", "content", "s", F.xxhash64(window).alias("w1"), F.xxhash64(F.lit(1), window).alias("w2"))
    twice = each.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    hits = lookup_join(each, twice, ["w1", "w2"]).groupBy("key", "content")
    hits = hits.agg(F.array_sort(F.collect_set("s")).alias("at"))  # at most one per byte of the piece
    # windows that overlap or touch make one span
    heads = F.filter("at", lambda s, i: F.coalesce(s - F.get(F.col("at"), i - 1) > length, F.lit(True)))
    tails = F.filter("at", lambda s, i: F.coalesce(F.get(F.col("at"), i + 1) - s > length, F.lit(True)))
    runs = hits.select("key", "content", F.explode(F.arrays_zip(heads.alias("s"), tails.alias("t"))).alias("run"))
    return runs.select("key", "content", F.col("run.s").alias("s"), (F.col("run.t") + length).alias("e"))


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """(d1, d2, spans): byte ranges, sorted, that repeated strings cover, of rows that have any."""
    rows = identified(docs)
    found = stored(pieces(rows, length, gram), "suffix-found")
    keys = (
        found.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("content").alias("low"),
            F.max("content").alias("high"),
            F.bool_or("inner").alias("twice"),
        )
        .filter("n > 1 OR twice")
        .select("key", (F.col("twice") | (F.col("low") != F.col("high"))).alias("mixed"))
    )
    hits = stored(lookup_join(found.drop("inner"), keys, "key"), "suffix-pieces")
    discard(found)
    mixed = hits.filter("mixed")
    place = F.struct("d1", "d2", "start", "size")
    contents = mixed.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(place).alias("at"))
    contents = stored(contents.select("key", "content", "n", "at.*"), "suffix-contents")
    weight = contents.groupBy("key").agg(F.sum(F.col("size").cast("long")).alias("different"))
    crowded = weight.filter(F.col("different") > hot_bytes)
    per_text = contents.groupBy("d1", "d2").agg(F.collect_list(F.struct("key", "content", "start", "size")).alias("own"))
    octets = F.encode("text", "UTF-8")
    cut = F.transform(
        "own",
        lambda p: F.struct(
            p["key"].alias("key"),
            p["content"].alias("content"),
            F.substring(octets, p["start"] + 1, p["size"]).alias("data"),
        ),
    )
    candidates = rows.join(per_text, ["d1", "d2"]).select(F.explode(cut).alias("p")).select("p.*")
    candidates = lookup_join(candidates, crowded, "key", "left")
    candidates = stored(candidates.withColumn("hot", F.col("different").isNotNull()).drop("different"), "suffix-bytes")
    total = candidates.filter("NOT hot").agg(F.sum(F.length("data").cast("long")).alias("n")).first()["n"] or 0
    data = candidates.select("key", "content", "data")
    spans = shard_spans(data.filter("NOT hot"), total, length, shard_bytes).unionByName(
        hot_spans(data.filter("hot"), length)
    )
    whole = contents.filter("n > 1").select("key", "content", F.lit(0).alias("s"), F.col("size").alias("e"))
    per_content = (
        spans.unionByName(whole)
        .groupBy("key", "content")
        .agg(F.collect_list(F.struct("s", "e")).alias("own"))  # at most one per byte of the piece
    )
    partial = lookup_join(mixed, per_content, ["key", "content"])
    partial = partial.select("d1", "d2", "start", F.explode("own").alias("o"))
    moved = F.struct((F.col("start") + F.col("o.s")).alias("s"), (F.col("start") + F.col("o.e")).alias("e"))
    partial = partial.select("d1", "d2", moved.alias("span"))
    equal = hits.filter("NOT mixed").select(
        "d1", "d2", F.struct(F.col("start").alias("s"), (F.col("start") + F.col("size")).alias("e")).alias("span")
    )
    return (
        partial.unionByName(equal)
        .groupBy("d1", "d2")
        .agg(F.sort_array(F.collect_set("span")).alias("spans"))  # bounded by the text
        .select("d1", "d2", "spans")
    )


def without(data: bytes, spans) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, maximal removed runs) of one text; ``spans`` are sorted."""
    kept, at, removed, runs = [], 0, 0, 0
    end = -1
    for s, e in spans:
        if s > end:
            runs += 1
            kept.append(data[at:s])
            removed += e - s
            end = e
        elif e > end:
            removed += e - end
            end = e
        at = end
    kept.append(data[at:])
    return b"".join(kept), removed, runs


def _joined(docs: DataFrame, **options) -> tuple[DataFrame, str]:
    d1, d2, spans = free_names(docs, "_d1", "_d2", "_spans")
    found = repeated_spans(docs, **options).select(
        F.col("d1").alias(d1),
        F.col("d2").alias(d2),
        F.transform("spans", lambda p: F.array(p["s"], p["e"])).alias(spans),
    )
    rows = docs.withColumns({d1: F.xxhash64("text"), d2: F.xxhash64(F.lit(1), "text", "doc_id")})
    return rows.join(found, [d1, d2], "left").drop(d1, d2), spans


def removal_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, NULL is empty. A byte goes if a string of ``length`` bytes over it starts
    anywhere else, in this text or another row; repeated rows repeat each other.
    """
    rows, spans = _joined(docs.select("doc_id", "text"), **options)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, own in zip(batch["doc_id"], batch["text"], batch[spans]):
                data = (text or "").encode("utf-8", "surrogatepass")
                kept, removed, runs = without(data, () if own is None else own)
                out.append((doc_id, len(data), int(removed), runs, hashlib.sha256(kept).hexdigest()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            frame = pd.DataFrame(out, columns=names)
            yield frame.assign(doc_id=batch["doc_id"].to_numpy())

    return rows.mapInPandas(
        run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``, and ``n_chars`` (if there) counted anew.

    A character of which only some bytes go, goes as a whole. Texts without repeats, and NULL, stay as
    they are; no row is dropped.
    """
    rows, spans = _joined(docs, **options)

    @F.pandas_udf("string")
    def rest(text: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series(
            [without(t.encode("utf-8", "surrogatepass"), o)[0].decode("utf-8", "ignore") for t, o in zip(text, own)]
        )

    touched = rows.filter(F.col(spans).isNotNull()).withColumn("text", rest("text", spans))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        touched = touched.withColumn("n_chars", F.length("text").cast(kind))
    out = touched.unionByName(rows.filter(F.col(spans).isNull()))
    return out.select(*docs.columns)
