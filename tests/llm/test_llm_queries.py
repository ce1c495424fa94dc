"""Every registered query of the subpackage on the smallest tables: whole results and plans."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checkset.compare import connect, rows_of
from edmart.llm.queries import ORACLES, QUERIES
from edmart.llm.shared import table

SF_DIR = os.environ.get("EDMART_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
PER_ROW = {
    "documents": [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op3", "op4", "op6", "op8", "op10", "op11", "op13")],
    "pages": [n for n in QUERIES if n.split("_")[0] in ("op5", "op9")],
}
NATIVE = ["op1_quality_rules", "op7_benchmark_templates"]


@pytest.mark.parametrize("name,source", [(n, t) for t, names in PER_ROW.items() for n in names])
def test_one_row_per_input_row(spark, name, source):
    df = QUERIES[name](spark, SF_DIR)
    key = "doc_id" if source == "documents" else "page_id"
    want = sorted(r[0] for r in table(spark, SF_DIR, source).select(key).collect())
    assert sorted(r[0] for r in df.select(key).collect()) == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    cur = connect(SF_DIR).execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


def test_leaks_are_those_of_a_plain_search(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}
    items = {r["item_id"]: r["text"] for r in table(spark, SF_DIR, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_benchmark_templates"](spark, SF_DIR).collect()}
    assert got == want


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"):
        assert word not in plan


def test_pipeline_stages_keep_columns_and_hand_on(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, n = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
    last = corpus_pipeline.run(spark, SF_DIR)
    rows = last.collect()
    assert 0 < len(rows) < n and all(r["round_trip"] for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)


def test_registered(spark):
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert [s for s, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
