import random

import pytest

from edmart.llm import sentencepieces as S
from tests_llm_values import LONG, MIXED

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("piece_bpe_32k.model")


def every_segmentation(model, text):
    whole = S.SPACE + text.replace(" ", S.SPACE) if text else ""
    pieces = {k: v for k, v in model.heads.items() if v}
    out = []

    def go(at, score, ids):
        if at == len(whole):
            out.append((score, tuple(ids)))
            return
        for end in range(at + 1, min(len(whole), at + 16) + 1):
            if whole[at:end] in pieces:
                go(end, score + pieces[whole[at:end]][0], ids + list(pieces[whole[at:end]][1]))
        if whole[at] not in pieces:
            go(at + 1, score + model.unknown_score, ids + [model.byte_ids[b] for b in whole[at].encode()])

    go(0, 0, [])
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("n", [1, 2, 5])
def test_n_best_equal_all_segmentations(path, n):
    model, rng = S.load_model(path), random.Random(n)
    encoder = S.Encoder(model, n)
    for _ in range(150):
        text = "".join(rng.choice(["th", "e", " ", "  ", "on", "\n", "é", "一", "in", ","]) for _ in range(rng.randint(0, 6)))
        every = every_segmentation(model, text)
        got = [(s, tuple(i for unit in own for i in unit)) for s, own in encoder.encode(text)]
        assert [s for s, _ in got] == [s for s, _ in every[:n]]
        assert len(set(got)) == len(got) and set(got) <= set(every)
        assert all(S.decode(model, list(ids)) == text for _, ids in got)


def test_whole_table_and_round_trip(spark, texts, path):
    docs = texts([*MIXED, LONG, "trailing ", " leading", "a\x00b"])
    encoded = S.encode_docs(docs, path, with_ids=True)
    rows = {r["doc_id"]: r for r in encoded.collect()}
    assert all(r["round_trip"] for i, r in rows.items() if i != 1)
    assert rows[0]["n_pieces"] == [0] == rows[1]["n_pieces"]
    back = {r["doc_id"]: r["text"] for r in S.decode_docs(encoded, path).collect()}
    assert back == {i: t or "" for i, t in enumerate([*MIXED, LONG, "trailing ", " leading", "a\x00b"])}
    assert S.encode_docs(docs.limit(0), path).count() == 0
    twice = texts(["ab", "ab"], ids=[None, None])
    assert S.encode_docs(twice, path).count() == 2


def test_all_n_segmentations_come_back(spark, texts, path):
    import zlib

    import numpy as np

    model = S.load_model(path)
    values = ["the other one", "é 一 €", "x" * 50, None, "a"]
    rows = {r["doc_id"]: r for r in S.encode_docs(texts(values), path, with_ids=True).collect()}
    for i, text in enumerate(values):
        r = rows[i]
        every = every_segmentation(model, text or "") if len(text or "") < 20 else None
        assert r["n_found"] == len(r["ids"]) == len({tuple(x) for x in r["ids"]})
        assert r["n_pieces"] == [len(x) for x in r["ids"]]
        assert r["ids_crc32"] == [zlib.crc32(np.array(x, dtype="<i4").tobytes()) for x in r["ids"]]
        assert all(S.decode(model, x) == (text or "") for x in r["ids"])
        if every is not None:
            assert r["scores"] == [s for s, _ in every[: S.N_BEST]]


def test_fractional_scores_keep_their_order():
    pieces = {"▁": (-1.0, 0), "a": (-1.5, 1), "b": (-1.25, 2), "ab": (-2.5, 3), "▁a": (-2.25, 4), "▁ab": (-3.625, 5)}
    model = S.make_model(pieces, list(pieces), [0] * 256)
    got = [s for s, _ in S.Encoder(model, 9).encode("ab")]
    assert got == sorted([-3.75, -3.5, -3.5, -3.625], reverse=True)


@pytest.mark.parametrize("unit", ["a", "x", "ab", "abba"])
def test_long_runs_end(path, unit):
    import time

    text = (unit * 100_000)[:100_000]
    model = S.load_model(path)
    start = time.process_time()
    found = S.Encoder(model, 4).encode(text)
    assert time.process_time() - start < 10  # a breadth-first search of the ties takes hours
    assert len(found) == 4 and found[0][0] >= found[1][0] >= found[2][0] >= found[3][0]
    ids = [tuple(i for part in own for i in part.tolist()) for _, own in found]
    assert len(set(ids)) == 4 and all(S.decode(model, list(x)) == text for x in ids)


def test_windows_and_generations_change_nothing(path, monkeypatch):
    model = S.load_model(path)
    values = [LONG[:3000], "some words, some words", "é" * 30 + " end", "", LONG[500:2500]]
    want = [[(s, [i for p in own for i in p.tolist()]) for s, own in S.Encoder(model, 3).encode(t)] for t in values]
    monkeypatch.setattr(S, "WINDOW_CHARS", 7)
    monkeypatch.setattr(S, "CACHE_UNITS", 5)
    monkeypatch.setattr(S, "CACHE_CHARS", 4)
    encoder = S.Encoder(model, 3)
    assert [[(s, [i for p in own for i in p.tolist()]) for s, own in encoder.encode(t)] for t in values] == want


def test_decoding_equals_the_library(path):
    spm = pytest.importorskip("sentencepiece")
    library = spm.SentencePieceProcessor(model_file=path)
    model = S.load_model(path)
    for text in ["Hello world", "naïve — “quotes”", "日本 語", "tab\there", "  two  spaces "]:
        ids = library.encode(text)
        assert S.decode(model, ids) == library.decode(ids)
