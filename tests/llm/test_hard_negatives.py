import math
import random

import numpy as np
import pytest

from edmart.llm import hard_negatives as H

SPEC = "vec_id long, label int, embedding array<float>, cell string, uid string, block string, lot string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SPEC)


def plain(rows, every=50):
    """All rows of the result by scoring all pairs; rows are (vec_id, label, vector)."""
    used = []
    for at, (i, label, v) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        used.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, label, v in used:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, k, other) for k, j, other, w in used if k != at]
        positives = sorted(s[:3] for s in scored if s[3] == label)[:5]
        for p, j, _ in positives:
            p = -p
            hard = sorted(s[:3] for s in scored if s[3] != label and 50 * p <= -100 * s[0] <= 95 * p)[:3]
            out += [(i, j, rank, n, p, -s) for rank, (s, n, _) in enumerate(hard, 1)]
    return sorted(out)


def found(spark, rows, **options):
    got = H.mine(frame(spark, rows), **options)
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got.collect())


def cloud(n, width, labels, seed, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] + rng.normal(size=width) / spread
        out.append((i, label, (v / np.linalg.norm(v)).astype(np.float32).tolist()))
    return out


@pytest.mark.parametrize("width,block_rows,codes", [(8, 64, 4), (9, 10_000, 16), (1, 100, 3)])
def test_equals_all_pairs(spark, width, block_rows, codes):
    rows = cloud(600, width, 10, 5)
    want = plain(rows)
    assert len(want) > 20 or width == 1
    assert found(spark, rows, block_rows=block_rows, codes=codes) == want


def test_ties_copies_and_anchor_lots(spark, monkeypatch):
    rng = random.Random(3)
    some = [[rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)] for _ in range(6)]
    rows = [(i, rng.randrange(3), some[min(rng.randrange(9), 5)]) for i in range(300)]  # a third are one vector
    monkeypatch.setattr(H, "ANCHOR_ROWS", 4)
    assert found(spark, rows, every=10, block_rows=32, codes=2) == plain(rows, 10)


def test_search_stops_before_the_end():
    import pyarrow as pa

    rows = cloud(4000, 4, 4, 9, spread=8.0)
    table = pa.table({
        "vec_id": [r[0] for r in rows], "uid": [r[0] for r in rows], "label": [r[1] for r in rows],
        "embedding": pa.array([r[2] for r in rows], pa.list_(pa.float32())),
        "cell": pa.array([0] * len(rows), pa.int32()),
    })
    points = H.matrix(table.column("embedding"), 4)
    books = [H.codebook(points[:, h], 16, 8) for h in H.halves(4)]
    a, b = (H.nearest(points[:, h], k) for h, k in zip(H.halves(4), books))
    block = H.Block(table.set_column(4, "cell", pa.array((a * 16 + b).astype(np.int32))), 4, 16)
    anchor = points[:1]
    (u1, l1), (u2, l2) = block.half_scores(anchor)
    bounds = [bound for bound, *_ in block.cells(u1[0], u2[0])]
    assert bounds == sorted(bounds, reverse=True) and len(bounds) == len(u1[0]) * len(u2[0])
    for bound, i, j in block.cells(u1[0], u2[0]):
        own = block.points[block.starts[i][j] : block.ends[i][j]] @ anchor[0]
        assert (own <= bound).all() and (own >= l1[0][i] + l2[0][j]).all()
    seen = []
    visits = block.visits
    block.visits = lambda *args: (seen.append(len(r)) or (bound, r) for bound, r in visits(*args))
    at, _ = block.positives(anchor[0], rows[0][1], 0, (u1[0], u2[0]), (l1[0], l2[0]), 5)
    assert len(at) == 5 and sum(seen) < len(rows) / 2


def test_rows_that_take_no_part(spark):
    good = cloud(200, 4, 10, 1)
    nan, inf = float("nan"), float("inf")
    odd = [
        (1000, None, [1.0] * 4), (1050, 3, None), (1100, 3, [1.0, nan, 0.0, 0.0]), (1150, 3, [inf, 1.0, 0.0, 0.0]),
        (1200, 3, [None, 1.0, 0.0, 0.0]), (None, 3, [1.0] * 4),
    ]
    assert found(spark, good + odd) == plain(good + odd)


def test_short_and_empty_vectors_and_tables(spark):
    rows = [(50, 1, [1.0, 1.0]), (51, 1, [1.0]), (52, 2, [0.7]), (53, 2, []), (54, 2, [0.5, 0.2])]
    wide = [(i, label, v + [0.0] * (2 - len(v))) for i, label, v in rows]
    assert found(spark, rows) == plain(wide) != []
    assert H.mine(frame(spark, rows).limit(0)).count() == 0
    assert found(spark, [(50, 1, []), (51, 1, []), (52, 2, [])]) == plain([(50, 1, [0.0]), (51, 1, [0.0]), (52, 2, [0.0])])


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="too large"):
        H.mine(frame(spark, [(50, 1, [1e20]), (51, 1, [1.0])])).collect()
