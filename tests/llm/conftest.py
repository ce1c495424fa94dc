import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

CLASHING = "_d1 long, _text_hash long, _spans string, shard int, hilbert int, n_words string, kept string"


@pytest.fixture
def texts(spark):
    """documents from texts: ids by position, the other columns of the table, and some with names operators use."""

    def build(values, ids=None, langs=None):
        ids = range(len(values)) if ids is None else ids
        langs = ["en"] * len(values) if langs is None else langs
        rows = [
            (i, t, lang, "src0", None if t is None else len(t), 1, 2, "x", 3, 4, "y", "z")
            for i, t, lang in zip(ids, values, langs)
        ]
        return spark.createDataFrame(
            rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        )

    return build


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
