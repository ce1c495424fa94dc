import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from edmart.llm import induced_sort as I
from edmart.llm import suffix_dedup as S
from tests_llm_values import LONG, MIXED


def plain(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone, end = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[max(k, end) : k + length] = b"\1" * (k + length - max(k, end))
                end = k + length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcé ") for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(100):
        text = ""
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 300)
            text += rng.choice(base)[a : a + rng.randint(5, 120)] + "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 30)))
        rows.append((i if i % 17 else None, text if i % 13 else None))
    return rows + rows[:5] + [(900, "a" * 500), (901, "ab" * 300), (902, "a" * 41), (903, "a" * 40)]


@pytest.mark.parametrize("hot", [20_000, 1])
def test_report_equals_a_plain_search(spark, hot):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.removal_report(df, length=40, gram=8, shard_bytes=2000, hot_bytes=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 40)


def test_production_length_and_odd_texts(spark, texts):
    values = [*MIXED, LONG, LONG[1000:3000], "q" + LONG[:250], "z" * 201, "z" * 200]
    got = S.removal_report(texts(values)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(list(enumerate(values)), 200)
    assert S.removal_report(texts([])).count() == 0


def test_texts_without_their_repeats(spark, texts):
    shared = "é" * 120
    docs = texts(["ab" + shared + "cd", "xy" + shared, None, "", "plain"])
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert rows == {0: ("abcd", 4), 1: ("xy", 2), 2: (None, None), 3: ("", 0), 4: ("plain", 5)}


@pytest.mark.parametrize("batch,memory", [(1, 0), (3, 100), (1 << 16, 1 << 20)])
def test_suffixes_and_prefixes_equal_a_plain_sort(monkeypatch, batch, memory):
    monkeypatch.setattr(I, "BATCH", batch)
    rng = random.Random(batch)
    for round_ in range(60):
        pieces = [bytes(rng.choice(b"ab" if round_ % 2 else b"abc") for _ in range(rng.randint(0, 30))) for _ in range(4)]
        text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, np.int16(0)) for p in pieces])
        cap = rng.choice([4, 12, 40])
        found = list(I.sorted_suffixes(text, cap, memory))
        order = np.concatenate([s for s, _ in found]).tolist()
        prefix = np.concatenate([p for _, p in found]).tolist()
        key = [tuple(text[i : i + cap].tolist()) for i in range(len(text))]
        assert sorted(order) == list(range(len(text)))
        for a, b, shared in zip(order, order[1:], prefix[1:]):
            x, y = key[a], key[b]
            same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert x >= y or x[: len(y)] == y
            # past the end only padding follows
            assert shared == same or shared > same == min(len(x), len(y))
