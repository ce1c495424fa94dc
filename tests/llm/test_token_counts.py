import random

import pytest

from edmart.llm import token_counts as T
from tests_llm_values import LONG, MIXED

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(path):
    library, rng = tokenizers.Tokenizer.from_file(path), random.Random(1)
    signs = "ab c\n\t \xa0é1!'st<|>endoftext \x1c\x0b\x85 　٣²ß日"
    values = [t or "" for t in MIXED] + ["a<|endoftext|>b<|endoftext|>", "<|endoftext|>" * 3, "aaaaaaaa" * 40, "'S's'll 'd"]
    values += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    counter = T.TokenCounter(T.load_vocabulary(path))
    want = [len(library.encode(v, add_special_tokens=False).ids) for v in values]
    assert counter.count(values) == want
    assert counter.count(values) == want  # from memory


def test_whole_table(spark, texts, path):
    library = tokenizers.Tokenizer.from_file(path)
    values = [*MIXED, LONG]
    rows = {r["doc_id"]: r for r in T.count_tokens(texts(values), path).collect()}
    for i, v in enumerate(values):
        n = len(library.encode(v or "", add_special_tokens=False).ids)
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"], rows[i]["over_limit"]) == (len((v or "").encode()), n, n > 1024)
    assert T.count_tokens(texts([]), path).count() == 0
    assert T.count_tokens(texts(["x", "x"], ids=[None, None]), path).count() == 2


def test_cache_bound_does_not_change_counts(path, monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 3)
    counter = T.TokenCounter(T.load_vocabulary(path))
    first = [counter.count([t or "" for t in MIXED]) for _ in range(3)]
    assert first[0] == first[1] == first[2]
