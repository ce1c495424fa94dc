import random

import numpy as np
import pytest
import xxhash

from edmart.llm import simhash as S
from edmart.llm.components import components
from tests_llm_values import LONG, MIXED


def plain_fingerprint(text):
    tokens = (text or "").encode().lower().split()
    grams = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    for text in [*MIXED, LONG[:5000], "A B c", "two words", "Ä Ö"]:
        assert S.fingerprint(text) == plain_fingerprint(text)


def plain_classes(prints, difference):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= difference and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return {frozenset(k for k, x in enumerate(label) if x == y) for y in label}


@pytest.mark.parametrize("small,block", [(64, 512), (2, 4)])
def test_links_equal_all_pairs(spark, small, block):
    rng = random.Random(7)
    prints = []
    for _ in range(12):  # families around a centre, some a chain
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            prints.append(centre)
            for _ in range(rng.randint(1, 3)):
                centre ^= 1 << rng.randrange(64)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(S.signed(p),) for p in prints], "fp long")
    linked = S.linked_pairs(df, small=small, block=block)
    roots = {r["node"] % 2**64: r["root"] for r in components(linked, "a", "b").collect()}
    groups = {}
    for k, p in enumerate(prints):
        groups.setdefault(roots.get(p, S.signed(p)), set()).add(k)
    assert {frozenset(g) for g in groups.values()} == plain_classes(prints, 2)
    for r in linked.collect():
        assert bin((r["a"] ^ r["b"]) % 2**64).count("1") <= 2


def test_pigeonring_lets_every_close_pair_pass(spark):
    rng = np.random.default_rng(3)
    for _ in range(300):
        diff = 0
        for b in rng.choice(64, rng.integers(1, 3), replace=False):
            diff |= 1 << int(b)
        starts = [
            s
            for s in range(S.SEGMENTS)
            if all(
                bin(diff & m).count("1") <= S.budget(n, S.SEGMENTS, 2) for n, m in enumerate(S.chain_masks(s), 1)
            )
        ]
        assert starts


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (5, 5)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(path, "a", "b").collect()}
    assert roots == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}
    assert components(path.limit(0), "a", "b").count() == 0


def test_whole_table(spark, texts):
    values = [*MIXED, "alpha beta gamma delta", "ALPHA beta  gamma delta", "alpha beta gamma delta", LONG, None]
    docs = texts(values)
    rows = {r["doc_id"]: r for r in S.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(v) for v in values]
    assert [rows[i]["fp"] % 2**64 for i in range(len(values))] == prints
    for group in plain_classes(prints, 2):
        assert {rows[i]["component_id"] for i in group} == {min(group)}
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(g) for g in plain_classes(prints, 2))
    assert S.near_duplicates(docs.limit(0)).count() == 0 == S.keep_one(docs.limit(0)).count()


def test_repeated_and_missing_ids(spark, texts):
    docs = texts(["same text here now", "same text here now", "other words stand there", "other words stand there"], ids=[3, 3, None, None])
    assert sorted(str(r["component_id"]) for r in S.near_duplicates(docs).collect()) == ["3", "3", "None", "None"]
    assert S.keep_one(docs).count() == 2
