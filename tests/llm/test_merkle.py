import hashlib
import zlib

import pytest

from edmart.llm import merkle as M
from tests_llm_values import LONG, MIXED


def seal(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return seal("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def grow(line):
    """All levels of the tree over one line of digests."""
    levels = [line]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([seal("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def ascend(levels, at, digest):
    siblings = ""
    for line in levels[:-1]:
        run = line[at // 8 * 8 : at // 8 * 8 + 8]
        left, right = "".join(run[: at % 8]), "".join(run[at % 8 + 1 :])
        siblings += left + right
        digest, at = seal(left + digest + right), at // 8
    return siblings, digest


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) from (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    grown = {g: grow([x[2] for x in sorted(trees[g], key=lambda x: x[:3])]) for g in order}
    top = grow([grown[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, (_, _, leaf, r) in enumerate(sorted(trees[g], key=lambda x: x[:3])):
            marked = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            start = leaf_of((*r[:4], lowered(r[4]))) if marked else leaf
            own, sub = ascend(grown[g], at, start)
            more, root = ascend(top, k, sub)
            out.append((r[0], leaf, grown[g][-1][0], top[-1][0], seal(own + more), root, root == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in M.verify(docs).collect()), key=str)


def frame(spark, rows):
    wide = [(*r, "clash", 1, b"x") for r in rows]
    spec = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, leaf binary"
    return spark.createDataFrame(wide, spec)


def sample(n, langs):
    texts = [*MIXED, LONG, "Some Words In Capitals", "no capitals here"]
    return [(7 * i + 3, f"s{i % 3}" if i % 5 else None, langs[i % len(langs)], i if i % 4 else None, texts[i % len(texts)]) for i in range(n)]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (1, [None]), (8, ["en"]), (9, ["en"]), (65, ["en"]), (150, [None, "en", "zz", "ä", ""])])
def test_equals_plain_trees(spark, n, langs):
    rows = sample(n, langs)
    assert found(frame(spark, rows)) == plain(rows)


def test_many_groups_grow_a_tree_of_subroots(spark):
    rows = [(i, None, f"g{i % 75:03}", 1, "Text" if i % 2 else "text") for i in range(160)]
    got = found(frame(spark, rows))
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}


def test_low_nodes_joined_by_key(spark, monkeypatch):
    rows = sample(150, ["en", "de", None])
    monkeypatch.setattr(M, "TOP_NODES", 4)
    assert found(frame(spark, rows)) == plain(rows)


def test_repeated_rows_missing_ids_and_empty_table(spark):
    rows = [(5, "s", "en", 1, "Same"), (5, "s", "en", 1, "Same"), (5, "s", "en", 1, "Other")] + [
        (None, None, None, None, None),
        (None, None, "en", None, "Words"),
    ]
    assert found(frame(spark, rows)) == plain(rows)
    assert all(r[-1] for r in found(frame(spark, rows)) if r[0] is None)
    empty = M.verify(frame(spark, rows).limit(0))
    assert set(COLUMNS) <= set(empty.columns) and empty.count() == 0


def test_row_limit_of_recursive_queries_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    M.verify(frame(spark, sample(20, ["en"]))).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
