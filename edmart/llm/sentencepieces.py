"""SentencePiece encoding with the N best segmentations, and decoding.

The piece lattice of a text falls apart wherever two neighbouring signs never stand side by
side inside a piece. In each such unit a forward Viterbi pass gives the
best score up to every position; these scores are exact heuristics for an A* search
back from the end, which meets segmentations in falling score. No position has to be left more than N times, and of
equal totals the search that is nearer to the start goes on first, so ties do not widen it. The Viterbi pass also
keeps the second best score: the N best of a text come from the N - 1 units that lose least by their second
choice, and only these are searched. Units are looked at once per task, up to a bound.
"""

from __future__ import annotations

import heapq
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.llm.token_counts import chunks

N_BEST = 4
CHUNK_CHARS = 4_000_000
WINDOW_CHARS = 1 << 20
CACHE_UNITS = 400_000  # units remembered in each of two generations
CACHE_CHARS = 64  # longer units are searched anew
SPACE = "▁"
UNKNOWN_PENALTY = 10
PAIR_BITS = 20
# Piece types of the model format. Fixed values.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6


@dataclass
class Model:
    """Pieces with score and ids, the text of every id (also as bytes), the ids of single bytes, known pairs of signs."""

    heads: dict[str, tuple[float, tuple[int, ...]]]
    texts: list[str | bytes]
    byte_ids: list[int]
    unknown_score: float
    pairs: np.ndarray = field(repr=False)
    octets: list[bytes] = field(init=False, repr=False)
    signs: frozenset[str] = field(init=False, repr=False)
    _finder: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __post_init__(self):
        self.octets = [t if isinstance(t, bytes) else t.encode("utf-8") for t in self.texts]
        self.signs = frozenset(piece for piece in self.heads if len(piece) == 1)

    @property
    def finder(self) -> ahocorasick.Automaton:
        """Finds all pieces in a text, ends rising; built where it is used first, as it does not travel to tasks."""
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for piece, (score, ids) in self.heads.items():
                self._finder.add_word(piece, (len(piece) - 1, score, ids))
            self._finder.make_automaton()
        return self._finder


def load_model(path: str) -> Model:
    """A model of byte fallback and unchanged text (identity normaliser, space put before the text)."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("the model changes its text")
    pieces, texts, byte_ids = {}, [], [0] * 256
    for i, p in enumerate(proto.pieces):
        texts.append(p.piece if p.type in (NORMAL, USER_DEFINED) else b"")
        if p.type in (NORMAL, USER_DEFINED):
            pieces[p.piece] = (float(p.score), i)
        elif p.type == BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
            texts[-1] = bytes([int(p.piece[3:5], 16)])
    return make_model(pieces, texts, byte_ids)


def pair_slots(codes: np.ndarray) -> np.ndarray:
    """The slot of each pair of neighbouring signs in the table of known pairs."""
    mixed = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def sign_codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def make_model(pieces: dict[str, tuple[float, int]], texts: list[str | bytes], byte_ids: list[int]) -> Model:
    pairs = np.zeros(1 << PAIR_BITS, dtype=bool)
    for piece in pieces:
        if len(piece) > 1:
            pairs[pair_slots(sign_codes(piece))] = True
    heads = {piece: (score, (i,)) for piece, (score, i) in pieces.items()}
    lowest = min((score for score, _ in pieces.values()), default=0.0)
    return Model(heads, texts, byte_ids, lowest - UNKNOWN_PENALTY, pairs)


def edges_of(model: Model, unit: str) -> Iterator[tuple[int, int, float, tuple[int, ...]]]:
    """(start, end, score, ids) of the pieces in a unit, ends rising; a sign that is no piece becomes its bytes."""
    pieces = model.finder.iter(unit)
    if model.signs.issuperset(unit):
        for last, (before, score, ids) in pieces:
            yield last - before, last + 1, score, ids
        return
    unknown = [i for i, sign in enumerate(unit) if sign not in model.signs]
    at = 0
    for last, (before, score, ids) in pieces:
        while at < len(unknown) and unknown[at] <= last:
            yield byte_edge(model, unit, unknown[at])
            at += 1
        yield last - before, last + 1, score, ids
    for i in unknown[at:]:
        yield byte_edge(model, unit, i)


def byte_edge(model: Model, unit: str, at: int) -> tuple[int, int, float, tuple[int, ...]]:
    octets = unit[at].encode("utf-8", "surrogatepass")
    return at, at + 1, model.unknown_score, tuple(model.byte_ids[b] for b in octets)


def segmentations(model: Model, unit: str, n: int) -> Iterator[tuple[float, tuple[int, ...]]]:
    """(score, ids) of the ``n`` best segmentations of a unit in falling score, found as they are asked for."""
    lost = float("-inf")
    best = [0.0] + [lost] * len(unit)
    edges: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in best]
    for start, end, score, ids in edges_of(model, unit):
        edges[end].append((start, score, ids))
        if best[start] + score > best[end]:
            best[end] = best[start] + score
    push, pop = heapq.heappush, heapq.heappop
    heap = [(-best[-1], len(unit), 0, 0.0, ())]
    left = [n] * len(best)
    pushed = 0
    while heap:
        _, at, _, score, tail = pop(heap)
        if not left[at]:
            continue
        left[at] -= 1
        if at == 0:
            ids: list[int] = []
            while tail:
                ids += tail[0]
                tail = tail[1]
            yield score, tuple(ids)
            if not left[0]:
                return
            continue
        for start, gain, own in edges[at]:
            pushed += 1
            gain += score
            push(heap, (-(gain + best[start]), start, pushed, gain, (own, tail)))


def packed(ids) -> bytes:
    """Ids as 4-byte little-endian numbers."""
    return array("i", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<i4").tobytes()


def look(model: Model, unit: str) -> tuple[float, bytes, float]:
    """(best score, its packed ids, loss of the second best or infinity): one Viterbi pass with the two best scores."""
    lost = float("-inf")
    size = len(unit) + 1
    first, second, back = [0.0] + [lost] * (size - 1), [lost] * size, [None] * size
    for start, end, score, ids in edges_of(model, unit):
        total = first[start] + score
        if total > first[end]:
            second[end] = max(first[end], second[start] + score)
            first[end], back[end] = total, (start, ids)
        else:
            # the best way over this edge is at most a second; all others over it are no better
            if total > second[end]:
                second[end] = total
    ids, at = [], size - 1
    while at:
        at, own = back[at]
        ids.append(own)
    return first[-1], packed(chain.from_iterable(reversed(ids))), first[-1] - second[-1]


class Encoder:
    """N-best encoding of whole texts; remembers what it found in units, in two generations of bounded size."""

    def __init__(self, model: Model, n: int):
        self.model, self.n = model, n
        self.known: dict[str, tuple[float, bytes, float]] = {}
        self.older: dict[str, tuple[float, bytes, float]] = {}
        self.searched: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        whole = SPACE + text.replace(" ", SPACE)
        cuts = [0]
        for at in range(0, len(whole), WINDOW_CHARS):
            codes = sign_codes(whole[at : at + WINDOW_CHARS + 1])
            cuts += (np.flatnonzero(~self.model.pairs[pair_slots(codes)]) + at + 1).tolist()
        return [whole[a:b] for a, b in zip(cuts, [*cuts[1:], len(whole)])]

    def found(self, units: list[str]) -> list[tuple[float, bytes, float]]:
        """(best score, packed ids, loss of the second best) of each unit."""
        own = {}  # units that are too long to remember, and those of this text
        for u in set(units).difference(self.known):
            hit = self.older.get(u) or look(self.model, u)
            (self.known if len(u) <= CACHE_CHARS else own)[u] = hit
        if own:
            out = [own.get(u) or self.known[u] for u in units]
        else:
            out = list(map(self.known.__getitem__, units))
        if len(self.known) > CACHE_UNITS:
            self.known, self.older = {}, self.known
        return out

    def encode(self, text: str) -> list[tuple[float, list[np.ndarray]]]:
        """Up to n of (score, ids as a list of stretches), best first; an empty text has one without ids."""
        units = self.units(text)
        found = self.found(units)
        each = list(map(itemgetter(1), found))
        ids = np.frombuffer(b"".join(each), dtype="<i4")
        score = sum(map(itemgetter(0), found))
        out = [(score, [ids])]
        if self.n == 1 or not units:
            return out
        losses = np.fromiter(map(itemgetter(2), found), dtype=np.float64, count=len(found))
        # any other unit's second choice loses at least as much as n - 1 better texts
        least = min(self.n - 1, len(losses))
        few = np.flatnonzero(losses <= np.partition(losses, least - 1)[least - 1])
        few = few[np.argsort(losses[few], kind="stable")][:least]
        few = sorted(int(k) for k in few if np.isfinite(losses[k]))
        options = [self.alternatives(units[k]) for k in few]
        starts = [sum(map(len, each[:k])) // 4 for k in few]
        spans = [(a, a + len(each[k]) // 4) for a, k in zip(starts, few)]
        # choices of the few units in falling score
        start = (0,) * len(few)
        heap, seen = [(0.0, start)], {start}
        while heap and len(out) <= self.n:
            loss, choice = heapq.heappop(heap)
            if any(choice):
                parts, at = [], 0
                for (a, b), c, option in zip(spans, choice, options):
                    if c:
                        parts += [ids[at:a], np.array(option[c][1], dtype="<i4")]
                        at = b
                out.append((score - loss, [*parts, ids[at:]]))
            for i, option in enumerate(options):
                if choice[i] + 1 < len(option):
                    step = (*choice[:i], choice[i] + 1, *choice[i + 1 :])
                    if step not in seen:
                        seen.add(step)
                        more = option[choice[i]][0] - option[choice[i] + 1][0]
                        heapq.heappush(heap, (loss + more, step))
        return out[: self.n]

    def alternatives(self, unit: str) -> list[tuple[float, tuple[int, ...]]]:
        """The n best of a unit, the first of them as in ``found``."""
        out = self.searched.get(unit)
        if out is None:
            out = list(segmentations(self.model, unit, self.n))
            if len(self.searched) >= CACHE_UNITS // 4:
                self.searched.clear()
            if len(unit) <= CACHE_CHARS:
                self.searched[unit] = out
        return out


def decode(model: Model, ids: list[int]) -> str:
    """The text of piece ids: bytes join to characters, wrong ones become U+FFFD, the space in front goes."""
    # a piece never begins inside a character, so joining all bytes first changes nothing
    octets = b"".join(map(model.octets.__getitem__, ids))
    return octets.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


def nested(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    """A list column from one list per row."""
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(list(chain.from_iterable(rows)), kind))


def encode_docs(docs: DataFrame, model_path: str, n: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """The ``n`` best segmentations of every row of ``docs`` (doc_id, text).

    Returns doc_id, n_found, and best first scores, n_pieces and ids_crc32 (of the ids as 4-byte
    little-endian numbers), round_trip (decoding the best gives the text), and with ``with_ids`` the
    ids of all, an array each. A text has fewer than ``n`` segmentations only if no more exist; NULL and empty texts
    have one, without pieces. The sign U+2581 in a text decodes to a space. Equal scores come in
    any order. Repeated rows and NULL ids are encoded each; other columns are not read.
    """
    model = load_model(model_path)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_found int, scores array<double>, n_pieces array<int>, ids_crc32 array<bigint>, "
        "round_trip boolean"
    )
    schema += ", ids array<array<int>>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, n)
        for batch in batches:
            at = 0
            for group in chunks(batch.column("text").to_pylist(), CHUNK_CHARS):
                scores, sizes, sums, trips, all_ids = [], [], [], [], []
                for text in group:
                    found = encoder.encode(text)
                    arrays = [np.concatenate(parts) for _, parts in found]
                    scores.append([s for s, _ in found])
                    sizes.append([len(a) for a in arrays])
                    sums.append([zlib.crc32(a.tobytes()) for a in arrays])
                    trips.append(decode(model, arrays[0].tolist()) == text)
                    all_ids.append(arrays if with_ids else [])
                columns = {
                    "doc_id": batch.column("doc_id").slice(at, len(group)),
                    "n_found": pa.array(map(len, scores), pa.int32()),
                    "scores": nested(scores, pa.float64()),
                    "n_pieces": nested(sizes, pa.int32()),
                    "ids_crc32": nested(sums, pa.int64()),
                    "round_trip": pa.array(trips, pa.bool_()),
                }
                if with_ids:
                    flat = list(chain.from_iterable(all_ids))
                    offsets = np.cumsum([0, *map(len, flat)]).astype(np.int32)
                    own = pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, "<i4"), *flat]))
                    columns["ids"] = pa.ListArray.from_arrays(np.cumsum([0, *map(len, all_ids)]).astype(np.int32), own)
                at += len(group)
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_docs(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``text``, decoded from the first of ``ids``; NULL ids give NULL."""
    model = load_model(model_path)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([None if own is None else decode(model, own) for own in ids])

    return encoded.withColumn("text", text(F.get("ids", F.lit(0))))
