"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os

import pytest

from checkset.compare import compare, connect
from checkset.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("EDMART_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_no_plan_pairs_everything_or_leaves_the_jvm(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for name, build in QUERIES.items():
            plan = build(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
            for word in ("NestedLoop", "Cartesian", "Python", "Window ["):
                assert word not in plan, (name, word)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# its stored table is itself a minimum of texts, which the merge has no part in
TEXT_MINIMUM = "merge_programs"


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("merge_") and n != TEXT_MINIMUM))
def test_merges_check_keys_without_sorting_rows(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "first(" not in plan
