"""Matching: hand-made cases, equality with the plain theta join, and plan shape."""

import random

import pytest
from pyspark.sql import functions as F

from edmart.operators import match
from edmart.operators.normalise import normalise_sources, normalise_universities
from tests.conftest import rows

SOURCES = "source_id string, source_name string, source_type string, is_enabled boolean, source_base_url string"
UNIS = "unitid int, instnm string, webaddr string"


def make_sources(frame, data):
    return normalise_sources(frame(data, SOURCES))


def make_unis(frame, data):
    return normalise_universities(frame(data, UNIS))


def test_host_before_name_and_no_match(frame):
    sources = make_sources(frame, [
        ("1", "Bar SRC_1", "a", True, "https://cs.foo.edu/courses"),
        ("2", "Baz SRC_2", "a", True, "https://xfoo.edu"),
        ("3", "Nowhere", "a", True, "https://nowhere.org"),
        ("4", "NoUrl Bar", "a", True, None),
    ])
    unis = make_unis(frame, [(9, "Foo College", "http://www.foo.edu"), (7, "bar", None), (8, "BAR", "https://bar.org/")])
    got = rows(match.match_sources(sources, unis), "source_name", "unitid", "match_type", "instnm", "uni_host", "rn")
    assert got == [
        ("Bar SRC_1", 9, "host_match", "Foo College", "foo.edu/", 1),
        ("Baz SRC_2", None, "no_match", None, None, 1),
        ("NoUrl Bar", 7, "name_match", "bar", None, 1),
        ("Nowhere", None, "no_match", None, None, 1),
    ]


def test_one_row_per_source_name(frame):
    sources = make_sources(frame, [
        ("b", "Foo", "catalog", True, "https://foo.edu"),
        ("a", "Foo", "directory", True, "https://elsewhere.org"),
    ])
    unis = make_unis(frame, [(2, "Other", "foo.edu"), (1, "Foo University", "zzz.org")])
    got = rows(match.match_sources(sources, unis), "source_name", "source_id", "unitid", "match_type")
    assert got == [("Foo", "b", 2, "host_match")]


def test_empty_name_matches_every_university(frame):
    sources = make_sources(frame, [("1", "Graduate", "a", True, "https://q.org")])
    unis = make_unis(frame, [(5, "X", "x.org"), (3, "Y", "y.org")])
    assert rows(match.match_sources(sources, unis), "source_name", "unitid", "match_type") == [("Graduate", 3, "name_match")]


def test_empty_urls_meet(frame):
    sources = make_sources(frame, [("1", "Abc", "a", True, "")])
    unis = make_unis(frame, [(5, "X", "")])
    assert rows(match.match_sources(sources, unis), "unitid", "match_type") == [(5, "host_match")]


def test_wildcards_in_data_are_plain_text(frame):
    sources = make_sources(frame, [("1", "a%b", "x", True, None), ("2", "axb", "x", True, None)])
    unis = make_unis(frame, [(1, "A%B", None)])
    got = rows(match.match_sources(sources, unis), "source_id", "match_type")
    assert got == [("1", "name_match"), ("2", "no_match")]


def test_similar_sources_filters_before_the_outer_join(frame):
    sources = make_sources(frame, [
        ("1", "alpha", "a", True, None), ("2", "beta", "a", False, None), ("3", "gamma", "a", True, None),
    ])
    courses = frame([("c1", "1"), ("c2", "2"), ("c3", "1")], "course_id string, course_source_id string")
    names = frame([("alp", None), ("beta", None), ("gamma", None), ("alp", "u"), (None, None)],
                  "source_name string, source_base_url string")
    assert rows(match.similar_sources(names, sources, courses)) == [
        (None, None), ("alp", "alpha"), ("beta", None), ("gamma", None),
    ]


def test_similar_universities(frame):
    unis = make_unis(frame, [(1, "Foo College", "foo.edu"), (2, "Foo College", "foo2.edu"), (3, "Bar", None)])
    names = frame([("Foo", None), ("Bar None", None), ("zzz", None), ("foo", None)],
                  "source_name string, source_base_url string")
    assert rows(match.similar_universities(names, unis)) == [
        ("Bar None", None), ("Foo", "foo.edu/"), ("Foo", "foo2.edu/"), ("foo", None), ("zzz", None),
    ]


def random_tables(frame, seed):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, n)))
    host = lambda: ".".join("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 2))) for _ in range(rnd.randint(1, 4)))
    maybe = lambda v: None if rnd.random() < 0.1 else v
    sources = [(str(i), word(6), rnd.choice("cd"), rnd.random() < 0.7, maybe("http://" + host())) for i in range(120)]
    sources += [(f"h{i}", "hot" + word(3), "c", True, "http://a.ab") for i in range(60)]
    unis = [(i, word(4), maybe(host())) for i in range(40)]
    return make_sources(frame, sources), make_unis(frame, unis)


@pytest.mark.parametrize("seed", range(4))
def test_match_equals_theta_join(spark, frame, seed):
    sources, unis = random_tables(frame, seed)
    sources.createOrReplaceTempView("s_rand")
    unis.createOrReplaceTempView("u_rand")
    plain = spark.sql("""
      WITH joined AS (SELECT s.*, u.unitid,
          s.src_host = u.uni_host OR endswith(s.src_host, '.' || u.uni_host) AS by_host
        FROM s_rand s LEFT JOIN u_rand u ON s.src_host = u.uni_host OR endswith(s.src_host, '.' || u.uni_host)
          OR contains(lower(s.cleaned_name), lower(u.instnm)) OR contains(lower(u.instnm), lower(s.cleaned_name))),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY source_name
        ORDER BY CASE WHEN by_host THEN 1 ELSE 2 END, unitid NULLS LAST, source_id) AS rn FROM joined)
      SELECT source_name, source_id, unitid,
        CASE WHEN by_host THEN 'host_match' WHEN unitid IS NOT NULL THEN 'name_match' ELSE 'no_match' END AS match_type
      FROM ranked WHERE rn = 1""")
    got = match.match_sources(sources, unis).select("source_name", "source_id", "unitid", "match_type")
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("seed", range(2))
def test_similar_equals_theta_join(spark, frame, seed):
    sources, unis = random_tables(frame, seed + 50)
    names = sources.select("source_name", "source_base_url")
    names.createOrReplaceTempView("n_rand")
    unis.createOrReplaceTempView("u_rand2")
    plain = spark.sql("""SELECT DISTINCT n.source_name, u.uni_host FROM n_rand n LEFT JOIN u_rand2 u
      ON contains(u.instnm, n.source_name) OR contains(n.source_name, u.instnm)""")
    assert rows(match.similar_universities(names, unis)) == rows(plain)


def test_contains_pairs_brute_force(frame):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 7)))
    longs, shorts = sorted({word() for _ in range(80)}), sorted({word() for _ in range(80)})
    got = match.contains_pairs(
        frame([(w,) for w in longs], "a string"), "a", frame([(w,) for w in shorts], "b string"), "b"
    )
    assert rows(got, "a", "b") == sorted((a, b) for a in longs for b in shorts if b in a)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_no_nested_loop_join(spark, frame, broadcast):
    sources, unis = random_tables(frame, 9)
    names = sources.select("source_name", "source_base_url")
    courses = frame([("c", "1")], "course_id string, course_source_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for df in (match.match_sources(sources, unis), match.similar_sources(names, sources, courses),
                   match.similar_universities(names, unis)):
            plan = plan_of(df)
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_name_is_split_by_aqe(spark, frame):
    """With broadcast off and tiny thresholds, the partition of a hot host is split."""
    hot = spark.range(60000).select(
        F.col("id").cast("string").alias("source_id"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("source_name"),
        F.lit("c").alias("source_type"), F.lit(True).alias("is_enabled"),
        F.when(F.col("id") % 3 == 0, F.lit("http://hot.edu")).otherwise(F.concat(F.lit("http://h"), F.col("id").cast("string"), F.lit(".org"))).alias("source_base_url"),
    ).repartition(8)
    sources = normalise_sources(hot)
    unis = make_unis(frame, [(1, "q-q-q", "hot.edu")])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = match.match_sources(sources, unis)
        assert df.filter("match_type = 'host_match'").count() == 20000
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for k in settings:
            spark.conf.unset(k)
