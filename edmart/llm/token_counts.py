"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are cut where no pre-token can span the cut, and equal pieces are counted once
per task. New pieces are cut into pre-tokens, which form one ragged array of symbols.
Each round finds the lowest-rank pair of every sequence and merges it everywhere in
that sequence at once; sequences without a pair leave. What survives is the count.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024
CHUNK_CHARS = 4_000_000
CACHE_PIECES = 1_000_000
_NO_RANK = np.int32(np.iinfo(np.int32).max)

# Pre-token pattern of the vocabulary. Fixed value.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_PIECE = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# White space beyond ASCII: such texts are cut by the pattern alone.
_OTHER_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_OTHER_SPACE = re.compile("[" + "".join(map(chr, _OTHER_SPACES)) + "]")


@dataclass
class Vocabulary:
    """Byte symbols, merges by pair, and the special strings of a tokenizer file."""

    byte_ids: np.ndarray
    pair_keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    size: int
    specials: list[str]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file: itself, or the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    vocab = data["model"]["vocab"]
    size = max(vocab.values()) + 1
    byte_ids = np.zeros(256, dtype=np.int64)
    for char, byte in byte_alphabet().items():
        byte_ids[byte] = vocab[char]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys)
    specials = [t["content"] for t in data.get("added_tokens", [])]
    return Vocabulary(byte_ids, keys[order], order.astype(np.int32), merged[order], size, specials)


def count_symbols(vocabulary: Vocabulary, sequences: list[bytes]) -> np.ndarray:
    """The number of symbols left of each byte string when no pair of it can merge."""
    lengths = np.array([len(s) for s in sequences], dtype=np.int64)
    left = lengths.copy()
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(sequences), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(sequences)), lengths)
    keys, last = vocabulary.pair_keys, len(vocabulary.pair_keys) - 1
    while len(symbols) > 1:
        pair = symbols[:-1] * vocabulary.size + symbols[1:]
        at = np.minimum(np.searchsorted(keys, pair), last)
        known = (keys[at] == pair) & (owner[:-1] == owner[1:])
        rank = np.append(np.where(known, vocabulary.ranks[at], _NO_RANK), _NO_RANK)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(rank, starts)
        chosen = np.flatnonzero((rank == np.repeat(lowest, sizes)) & (rank != _NO_RANK))
        if len(chosen) == 0:
            break
        # in a run of one symbol every second pair merges, from the left
        run = np.append(True, np.diff(chosen) != 1)
        chosen = chosen[(chosen - chosen[run][np.cumsum(run) - 1]) % 2 == 0]
        symbols[chosen] = vocabulary.merged[at[chosen]]
        np.subtract.at(left, owner[chosen], 1)
        stays = np.repeat(lowest != _NO_RANK, sizes)
        stays[chosen + 1] = False
        symbols, owner = symbols[stays], owner[stays]
    return left


class TokenCounter:
    """Counts tokens of whole texts; remembers pieces up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PRE_TOKEN)
        self.special = re.compile("|".join(map(re.escape, vocabulary.specials))) if vocabulary.specials else None
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and _OTHER_SPACE.search(text):
            return self.pattern.findall(text)
        return _PIECE.findall(text)

    def learn(self, new: Iterable[str]) -> None:
        new = list(new)
        tokens = [self.pattern.findall(p) for p in new]
        distinct = {t: i for i, t in enumerate(dict.fromkeys(t for ts in tokens for t in ts))}
        if distinct:
            counts = count_symbols(self.vocabulary, [t.encode("utf-8", "surrogatepass") for t in distinct]).tolist()
            self.known.update((p, sum(counts[distinct[t]] for t in ts)) for p, ts in zip(new, tokens))

    def count(self, texts: list[str]) -> list[int]:
        cut: list[tuple[int, list[str]]] = []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            cut.append((len(parts) - 1, [p for part in parts for p in self.pieces(part)]))
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        self.learn(p for p in set().union(*[own for _, own in cut]) if p not in self.known)
        return [n + sum(map(self.known.__getitem__, own)) for n, own in cut]


def chunks(texts: Iterable[str | None], most: int) -> Iterator[list[str]]:
    """The texts in order, a few together: up to ``most`` characters, or one longer text."""
    group, chars = [], 0
    for text in texts:
        text = text or ""
        if group and chars + len(text) > most:
            yield group
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    if group:
        yield group


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text).

    NULL counts as the empty text: no bytes, no tokens. A special string inside a text is
    one token. Repeated rows and NULL ids are counted each; other columns are not read.
    The vocabulary file is read on the driver and travels with the job.
    """
    vocabulary = load_vocabulary(vocabulary_path)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = TokenCounter(vocabulary)
        for batch in batches:
            counts = [n for group in chunks(batch["text"], CHUNK_CHARS) for n in counter.count(group)]
            yield batch.drop(columns="text").assign(n_tokens=np.array(counts, dtype=np.int64))

    rows = docs.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = rows.mapInPandas(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
