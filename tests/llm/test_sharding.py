import itertools

import numpy as np
import pytest

from edmart.llm import sharding as S
from tests_llm_values import MIXED


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 1), (1, 4)])
def test_curve_is_one_walk_through_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = S.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_gapless_and_follow_the_curve(spark, texts):
    n = 1003
    docs = texts([f"t{i % 50}" * (i % 37) for i in range(n)], langs=["en" if i % 3 else "de" for i in range(n)])
    rows = S.assign_shards(docs, ["lang", "source", "n_chars"], ["doc_id"]).collect()
    assert len(rows) == n
    sizes = [sum(r["shard"] == s for r in rows) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["hilbert"], r["doc_id"]) for r in order]
    assert keys == sorted(keys)
    again = S.assign_shards(docs.repartition(7), ["lang", "source", "n_chars"], ["doc_id"]).collect()
    place = lambda found: {r["doc_id"]: (r["shard"], r["slot"]) for r in found}
    assert place(rows) == place(again)


def test_odd_rows(spark, texts):
    docs = texts(MIXED + ["same"] * 9, ids=[*range(len(MIXED)), *[None] * 3, *[5] * 6], langs=[None] * (len(MIXED) + 9))
    rows = S.assign_shards(docs, ["lang", "n_chars"], ["doc_id"]).collect()
    assert len(rows) == len(MIXED) + 9
    assert S.assign_shards(docs.limit(0), ["lang", "n_chars"], ["doc_id"]).count() == 0
    few = S.assign_shards(docs.limit(3), ["lang"], ["doc_id"]).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]


def test_files_prune_by_their_ranges(spark, texts):
    docs = texts(["x" * (i % 97) for i in range(800)], langs=[f"l{i % 16:02d}" for i in range(800)])
    sharded = S.assign_shards(docs, ["lang", "n_chars"], ["doc_id"], file_rows=25)
    path, listed = S.write_and_list(sharded, ["lang", "n_chars"])
    files = listed.collect()
    assert sum(r["n_rows"] for r in files) == 800 and spark.read.parquet(path).count() == 800
    hit = [r for r in files if r["min_lang"] <= "l03" <= r["max_lang"] and r["min_n_chars"] <= 10]
    assert 0 < len(hit) <= len(files) / 4


def test_texts_with_a_common_beginning_fall_apart(spark, texts):
    docs = texts(["x"] * 400, langs=[f"https://www.commoncrawl.example/{i % 16:02d}" for i in range(400)])
    rows = S.assign_shards(docs, ["lang"], ["doc_id"]).collect()
    assert len({r["hilbert"] for r in rows}) >= 12
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], set()).add(r["hilbert"])
    assert all(len(v) == 1 for v in by_lang.values())
    assert sorted(by_lang, key=lambda k: min(by_lang[k])) == sorted(by_lang, key=lambda k: (min(by_lang[k]), k))


def test_no_column_is_lost(spark, texts):
    docs = texts(["a", "b", None]).selectExpr("*", "doc_id * 2 AS `_part`", "'r' AS `_rank`", "7 AS `slot`", "8 AS `FILE`")
    out = S.assign_shards(docs, ["lang", "shard"], ["doc_id"])
    rows = out.collect()
    assert set(docs.columns) - {"shard", "hilbert", "slot", "FILE"} <= set(out.columns)
    assert {"shard_", "hilbert_", "slot_", "FILE_", "shard", "hilbert", "slot", "file"} <= set(out.columns)
    assert [r["slot_"] for r in rows] == [7] * 3 and sorted(r["_part"] for r in rows) == [0, 2, 4]
