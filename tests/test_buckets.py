"""Tables stored in buckets: joins on the key move no text."""

import re

import pytest
from pyspark.sql import functions as F

from edmart.plans import marts
from edmart.sources.tables import Tables, save_bucketed
from tests.conftest import rows


@pytest.fixture
def tables(spark, frame):
    courses = spark.range(200).select(
        F.col("id").cast("string").alias("course_id"), (F.col("id") % 3).cast("string").alias("course_source_id"),
        F.concat(F.lit("t"), "id").alias("course_title"), F.concat(F.lit("long text "), "id").alias("course_description"),
    )
    bridge = spark.range(600).select(
        (F.col("id") % 250).cast("string").alias("course_id"), (F.col("id") % 7).cast("string").alias("taxonomy_id")
    )
    return Tables({
        "courses": courses, "course_taxonomy01": bridge,
        "taxonomy01": frame([(str(k), f"d{k}") for k in range(6)], "taxonomy_id string, taxonomy_description string"),
        "sources": frame([("0", "Zero"), ("1", "One")], "source_id string, cleaned_name string"),
    })


def moved_columns(df):
    """The input columns of every exchange of the plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]", text)


def test_course_texts_are_not_moved(spark, tables, tmp_path):
    want = rows(marts.courses_with_taxonomy(tables))
    stored = {
        name: save_bucketed(tables[name], f"bucketed_{name}", str(tmp_path / name), "course_id", 4)
        for name in ("courses", "course_taxonomy01")
    }
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for s in settings:
            spark.conf.set(s, "-1")
        plain = marts.courses_with_taxonomy(tables)
        assert any("course_description" in m for m in moved_columns(plain))
        got = marts.courses_with_taxonomy(tables.with_tables(**stored))
        moved = moved_columns(got)
        assert moved and not any("course_description" in m for m in moved)
        assert rows(got) == want
    finally:
        for s in settings:
            spark.conf.unset(s)
        for name in stored:
            spark.sql(f"DROP TABLE bucketed_{name}")


def test_a_stored_table_is_replaced_whole(spark, tables, tmp_path):
    try:
        for part in (tables.courses, tables.courses.limit(5)):
            got = save_bucketed(part, "bucketed_again", str(tmp_path / "again"), "course_id", 2)
        assert got.count() == 5 and len(list((tmp_path / "again").glob("*.parquet"))) <= 2
    finally:
        spark.sql("DROP TABLE bucketed_again")
