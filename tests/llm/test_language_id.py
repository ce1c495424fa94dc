import random
import zlib

import numpy as np

from edmart.llm import language_id as L
from tests_llm_values import LONG, MIXED

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ver", "ö"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


def test_held_out_accuracy_and_contract(spark, texts):
    rng = random.Random(1)
    langs = [rng.choice(["aa", "bb"]) for _ in range(120)]
    docs = texts([sentence(rng, k, rng.randint(5, 60)) for k in langs], langs=langs)
    rows = L.identify(docs, per_language=40).collect()
    truth = dict(enumerate(langs))
    assert {r["doc_id"]: r["held_out"] for r in rows} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and 0 <= r["labelled_share"] <= 1 for r in rows)


def test_odd_texts(spark, texts):
    docs = texts([*MIXED, "123 !?", LONG, "abc"], langs=["aa"] * 10 + [None, "bb", None])
    rows = {r["doc_id"]: r for r in L.identify(docs).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 2, 3, 10)] == ["und"] * 5
    assert rows[11]["lang_pred"] in ("aa", "bb") and rows[12]["lang_pred"] in ("aa", "bb")
    assert L.identify(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in L.identify(docs.filter("lang IS NULL")).collect()} == {"und"}


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in L.layer(rng, 3).items()}
    x = rng.integers(0, 5, (6, 4)).astype(np.uint8)
    mask = np.ones((6, 4), np.float32)
    mask[4:, 1] = 0
    weight = rng.normal(size=(6, 3, 4))

    def loss(params):
        q = {k: v.astype(np.float32) for k, v in params.items()}
        return float((L.read(q, x, mask) * weight).sum())

    trace = []
    q = {k: v.astype(np.float32) for k, v in p.items()}
    states = L.read(q, x, mask, trace)
    grads = L.unread(q, x, mask, states, trace, weight.astype(np.float32))
    for name in p:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            if name == "x":
                at = (at[0], int(x[0, 0]))
            up, down = ({**p, name: p[name].copy()} for _ in range(2))
            up[name][at] += 1e-2
            down[name][at] -= 1e-2
            assert abs((loss(up) - loss(down)) / 2e-2 - grads[name][at]) < 2e-2


def test_windows_cover_every_byte_once():
    parts = [b"", b"abc", bytes(range(200)), b"x" * 256]
    x, mask, owner = L.windows(parts, 128)
    assert mask.sum() == sum(map(len, parts))
    flat = x.T.reshape(-1)[mask.T.reshape(-1) > 0].tobytes()
    assert flat == b"".join(parts)
    assert owner.tolist() == [1, 2, 2, 3, 3]
