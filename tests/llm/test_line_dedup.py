import hashlib

import pytest

from edmart.llm import line_dedup as L
from tests_llm_values import LONG, MIXED

SPACES = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain(docs, min_docs=2):
    """The kept lines of each (doc_id, text), in the order given; ids of None come last."""
    holders = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add((i is None, i or 0))
    out = []
    for i, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            own = holders[key_of(line)]
            lost = len(key_of(line)) >= 10 and len(own) >= min_docs and (i is None, i or 0) != min(own)
            kept += [] if lost else [line]
        out.append((i, kept))
    return out


def report(docs):
    out = []
    for (i, text), (_, kept) in zip(docs, plain(docs)):
        n = len((text or "").split("\n"))
        out.append((i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in L.line_report(df).collect()), key=str)


VALUES = [
    *MIXED,
    LONG,
    "A shared line of text\nsomething else entirely\n\nA shared line of text",
    "  a SHARED line of Text\t\nown words stand here\r\n",
    "short one\nshort one\nÄÖÜ shared but not lowered",
    "short one\näöü shared but not lowered\n\n\n",
    "a shared line of text",
    "\n".join(f"line number {i % 50}" for i in range(5000)),
    "line number 7\nline number 49\nline number 50 is new",
    "ten chars!\n日本語のとても長い一行です",
    "ten chars!\n日本語のとても長い一行です\nnine char",
    "nine char",
]


def test_equals_plain_counts(spark, texts):
    docs = list(enumerate(VALUES))
    assert found(texts(VALUES)) == report(docs)
    kept = L.drop_repeated_lines(texts(VALUES))
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == texts(VALUES).columns
    for (i, text), (_, lines) in zip(docs, plain(docs)):
        want = "\n".join(lines) if text is not None else None
        assert rows[i]["text"] == want
        assert rows[i]["n_chars"] == (None if want is None else len(want))


def test_repeated_and_missing_ids(spark, texts):
    line = "the very same line of words"
    docs = [(3, line), (3, line), (3, line + "\nx"), (9, line), (None, line), (None, "alone among rows without id"), (None, "alone among rows without id")]
    assert found(texts([t for _, t in docs], ids=[i for i, _ in docs])) == report(docs)


@pytest.mark.parametrize("min_docs", [2, 3, 4])
def test_threshold(spark, texts, min_docs):
    values = ["first common line", "first common line\nsecond common line", "second common line", "first common line"]
    rows = {r["doc_id"]: r["text"] for r in L.drop_repeated_lines(texts(values), min_docs=min_docs).collect()}
    assert [rows[i] for i in range(4)] == ["\n".join(k) for _, k in plain(list(enumerate(values)), min_docs)]


def test_empty_table(spark, texts):
    assert L.line_report(texts(["x"]).limit(0)).count() == 0 == L.drop_repeated_lines(texts(["x"]).limit(0)).count()
