"""Plans under skew: with broadcast off and one key owning a third of all rows, the hot partition is split.

Thresholds are scaled down to the test data; the rest is Spark's default.
"""

import pytest
from pyspark.sql import functions as F

from edmart.functions import text
from edmart.operators import counts, merge, repair, staging, validate
from edmart.plans import linking, marts
from edmart.sources.tables import Tables

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}
N = 60_000


@pytest.fixture
def skewed(spark):
    """(hot key, rows): ``key`` is 'hot' for a third of the rows, else nearly unique; written so joins see a scan."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    df = spark.range(0, N, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    yield df
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def splits(df):
    n = len(df.collect())
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString(), n


def test_merge_into_a_hot_target_key(spark, skewed):
    target = skewed.select(F.col("key").alias("source_name"), "id", F.col("payload").alias("source_type"))
    batch = spark.createDataFrame([("hot", "new"), ("fresh", "new")], "source_name string, source_type string")
    got = merge.merge_table(target, batch, ["source_name"], update=["source_type"])
    assert splits(got) == (True, N + 1)


def test_drop_orphans_of_a_hot_code(spark, skewed):
    programs = spark.createDataFrame([("hot",), ("k1",)], "cipcode string").distinct()
    facts = skewed.select(F.col("key").alias("cipcode"), "payload")
    assert splits(repair.drop_orphans(facts, programs)) == (True, N // 3 + 1)


def test_missing_codes_do_not_gather_in_one_task(spark, skewed):
    programs = spark.createDataFrame([("k1",)], "cipcode string")
    facts = skewed.select(F.when(F.col("key") != "hot", F.col("key")).alias("cipcode"), "id", "payload")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = repair.drop_orphans(facts, programs)
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == N // 3 + 1 and len(sizes) == 8 and max(sizes) < N // 3 / 4


def test_cascade_of_a_hot_source(spark, skewed):
    logs = skewed.select(F.col("id").alias("log_id"), F.col("key").alias("log_source_id"), "payload")
    sources = spark.createDataFrame([("hot",), ("k1",)], "source_id string")
    gone = sources.filter("source_id = 'k1'").distinct()
    left = repair.delete_cascade({"sources": sources, "logs": logs}, "sources", gone)
    assert splits(left["logs"]) == (True, N - 1)


def test_link_a_hot_name(spark, skewed):
    sources = skewed.select(F.col("id").cast("string").alias("source_id"), F.col("key").alias("cleaned_name"), "payload")
    linked = linking.link_sources(sources, linking.register_distinct(sources))
    assert splits(linked) == (True, N)
    assert linked.filter("source_distinct_id IS NULL").count() == 0


def test_courses_of_a_hot_source(spark, skewed):
    courses = skewed.select(
        F.col("id").cast("string").alias("course_id"), F.col("key").alias("course_source_id"),
        F.col("payload").alias("course_title"), F.col("payload").alias("course_description"),
        F.lit("x").alias("course_code"), F.lit("1").alias("course_credits"),
    )
    sources = spark.createDataFrame([("hot", "h"), ("k1", "k")], "source_id string, cleaned_name string")
    assert splits(staging.course_data(courses, sources)) == (True, N // 3 + 1)
    per_name = counts.distinct_course_counts(courses, sources)
    assert splits(per_name) == (True, 2)
    assert sorted(tuple(r) for r in per_name.collect()) == [("h", N // 3), ("k", 1)]


def test_completions_of_a_hot_university(spark, skewed):
    rows = skewed.select(
        F.lit(2020).alias("report_year"),
        F.when(F.col("key") == "hot", 1).otherwise(F.col("id").cast("int")).alias("unitid"),
        F.lit("11.0101").alias("cipcode"), F.lit(3).alias("award_level"), (F.xxhash64("id") % 1000000 + 1000000).cast("int").alias("total_completions"),
    )
    units = spark.createDataFrame([(1,), (2,)], "unitid int")
    programs = spark.createDataFrame([("11.0101",)], "c string").select(F.col("c").cast("decimal(10,4)").alias("cipcode"))
    ok, n = splits(validate.valid_completions(rows, units, programs))
    assert ok and n == N // 3 + 2
    late = validate.aggregate_completions(validate.valid_completions(rows, units, programs))
    early = validate.completions_batch(rows, units, programs)
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.collect()))


def test_hot_taxonomy_and_source(spark, skewed):
    t = Tables({
        "courses": skewed.select(
            F.col("id").cast("string").alias("course_id"), F.col("key").alias("course_source_id"),
            F.col("payload").alias("course_title"), F.col("payload").alias("course_description")),
        "course_taxonomy01": skewed.select(F.col("id").cast("string").alias("course_id"), F.col("key").alias("taxonomy_id")),
        "taxonomy01": spark.createDataFrame([("hot", "d")], "taxonomy_id string, taxonomy_description string"),
        "sources": spark.createDataFrame([("hot", "h")], "source_id string, cleaned_name string"),
    })
    assert splits(marts.courses_with_taxonomy(t)) == (True, N // 3)


def test_digest_keeps_descriptions_out_of_the_shuffle(spark, skewed):
    courses = skewed.select(F.col("key").alias("course_source_id"), F.col("payload").alias("course_title"),
                            F.col("payload").alias("course_description"))
    sources = spark.createDataFrame([("hot", "h")], "source_id string, cleaned_name string")
    plan = counts.distinct_course_counts(courses, sources)._jdf.queryExecution().executedPlan().toString()
    below_exchange = [line for line in plan.splitlines() if "Exchange" in line]
    assert below_exchange and not any("course_description" in line for line in below_exchange)
    assert courses.select(text.row_digest("course_title", "course_description").alias("d")).first()["d"]


def test_slots_messages_of_a_hot_run(spark, skewed):
    rows = spark.createDataFrame(
        [("hot", 1, "end", 5), ("k1", 1, "end", 1), ("k2", 1, None, 3), ("quiet", None, "end", 0)],
        "source_id string, max_run_id int, end_message string, slots_rows long",
    )
    logs = skewed.select(
        F.col("key").alias("log_source_id"), F.lit(1).alias("log_run_id"), F.col("id").cast("timestamp").alias("log_ts"),
        F.concat(F.lit("scrape (slots left: 3)"), F.col("payload")).alias("log_message"),
    )
    got = marts._with_slots_log(rows, logs)
    assert splits(got) == (True, N // 3 + 3)
    empty = {r["source_id"] for r in got.filter("slots_message IS NULL").collect()}
    assert empty == {"k2", "quiet"} and got.columns[-2:] == ["slots_ts", "slots_message"]
