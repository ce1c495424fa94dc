"""Merges, audit, checks, repair, cascade, history and schema fitting."""

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from edmart import schemas
from edmart.operators import audit, checks, history, merge, repair
from tests.conftest import rows

def now():
    return F.lit("2025-06-05 12:00:00").cast("timestamp")


NOON = datetime(2025, 6, 5, 12)


def test_save_courses_null_code_and_title(frame):
    schema = "course_id string, course_source_id string, course_title string, course_description string, course_code string, course_credits string"
    stored = frame([
        ("a", "s1", "Algebra", "old", "", "3"), ("b", "s1", None, "untitled", "X", "1"), ("c", "s2", "Algebra", "other", None, "2"),
    ], schema)
    batch = frame([(None, "Algebra", "new", None), ("X", None, "again", "1"), ("N", "New", "d", "4")],
                  "course_code string, course_title string, course_description string, course_credits string")
    got = merge.save_courses(stored, batch, source_id="s1")
    assert rows(got, "course_source_id", "course_title", "course_code", "course_description", "course_credits") == sorted([
        ("s1", "Algebra", None, "new", None),
        ("s1", None, "X", "untitled", "1"),
        ("s1", None, "X", "again", "1"),
        ("s2", "Algebra", None, "other", "2"),
        ("s1", "New", "N", "d", "4"),
    ], key=lambda r: [(v is not None, str(v)) for v in r])
    assert got.filter("course_id IS NULL").count() == 0 and got.select("course_id").distinct().count() == 5


def test_upsert_sources_clears_urls_and_keeps_settings(frame):
    stored = frame([("1", "Foo", "old", "https://x", 3, False), ("2", "Bar", "b", "https://y", 4, True)],
                   "source_id string, source_name string, source_type string, source_base_url string, source_crawl_depth int, is_enabled boolean")
    batch = frame([("Foo", "new", None, None, None), ("New", "n", "https://n", 1, None), ("Off", "n", None, None, False)],
                  "source_name string, source_type string, source_base_url string, source_crawl_depth int, is_enabled boolean")
    got = merge.upsert_sources(stored, batch)
    assert rows(got, "source_name", "source_type", "source_base_url", "source_crawl_depth", "is_enabled") == [
        ("Bar", "b", "https://y", 4, True), ("Foo", "new", None, 3, False),
        ("New", "n", "https://n", 1, True), ("Off", "n", None, None, False),
    ]
    assert rows(merge.source_ids(got, batch).filter("source_name = 'Foo'"), "source_id") == [("1",)]
    assert merge.source_conflicts(got).count() == 0


def test_one_name_under_two_types_is_reported(frame):
    stored = frame([("1", "Foo", "a"), ("2", "Foo", "b")], "source_id string, source_name string, source_type string")
    batch = frame([("Foo", "c")], "source_name string, source_type string")
    got = merge.upsert_sources(stored, batch)
    assert rows(got) == [("1", "Foo", "c"), ("2", "Foo", "c")]
    assert rows(merge.source_conflicts(got)) == [("Foo", "c", 2)]


def test_duplicate_source_key_fails(frame):
    stored = frame([(1, 2020, 1, 5)], "unitid int, report_year int, student_level smallint, total_headcount int")
    batch = frame([(1, 2021, 1, 5), (1, 2021, 1, 6)], stored.schema)
    for _ in range(5):
        with pytest.raises(PySparkException, match="several rows for key"):
            merge.upsert_enrollment(stored, batch).collect()


def test_null_keys_are_inserted_not_matched(frame):
    schema = "unitid int, report_year int, grtype smallint, grtotlt int"
    stored = frame([(None, 2020, 1, 5), (1, 2020, 1, 7)], schema)
    batch = frame([(None, 2020, 1, 6), (None, 2020, 1, 6), (1, 2020, 1, 8)], schema)
    assert rows(merge.upsert_gradrates(stored, batch), "unitid", "grtotlt") == [
        (None, 5), (None, 6), (None, 6), (1, 8),
    ]


def test_fact_ids_continue(frame):
    stored = frame([(41, 2020, 1, Decimal("1.0100"), 3, 5)],
                   "completion_id bigint, report_year int, unitid int, cipcode decimal(10,4), award_level int, total_completions int")
    batch = frame([(2020, 1, "1.01", 3, 9), (2020, 1, "01.0200", 3, 1), (2021, 1, "1.01", 3, 2)],
                  "report_year int, unitid int, cipcode string, award_level int, total_completions int")
    got = merge.upsert_completions(stored, batch)
    assert rows(got, "report_year", "cipcode", "total_completions") == [
        (2020, Decimal("1.0100"), 9), (2020, Decimal("1.0200"), 1), (2021, Decimal("1.0100"), 2),
    ]
    ids = [r[0] for r in got.select("completion_id").collect()]
    assert len(set(ids)) == 3 and sorted(ids)[0] == 41 and got.schema == stored.schema


def test_audit_stamps(frame):
    base = frame([("1", "a", "old"), ("2", "b", "old")], "scraper_schema_id string, scraper_schema_source_id string, scraper_schema_json string")
    then = F.lit("2020-01-01 00:00:00").cast("timestamp")
    stored = audit.with_audit(base, "scraper_schemas", user=F.lit("me"), now=then, row_id=F.col("scraper_schema_id"))
    batch = frame([("b", "new"), ("c", "new")], "scraper_schema_source_id string, scraper_schema_json string")
    got = merge.save_schemas(stored, batch, audit="scraper_schemas", user=F.lit("you"), now=now())
    assert rows(got, "scraper_schema_source_id", "scraper_schema_json", "scraper_schemas_crtd_id", "scraper_schemas_crtd_dt",
                "scraper_schemas_updt_id", "scraper_schemas_updt_dt") == [
        ("a", "old", "me", datetime(2020, 1, 1), None, None),
        ("b", "new", "me", datetime(2020, 1, 1), "you", NOON),
        ("c", "new", "you", NOON, None, None),
    ]
    assert got.select("scraper_schemas_table_id").distinct().count() == 3
    # a second run changes nothing but the stamps
    again = merge.save_schemas(got, batch, audit="scraper_schemas", user=F.lit("you"), now=now())
    assert rows(again.drop("scraper_schemas_updt_id", "scraper_schemas_updt_dt", "scraper_schemas_table_id")) == rows(
        got.drop("scraper_schemas_updt_id", "scraper_schemas_updt_dt", "scraper_schemas_table_id"))


def test_audit_columns_only_where_missing(frame):
    df = frame([(1,)], "a int")
    assert audit.with_audit(df, "a__dbt_tmp").columns == ["a"]
    assert audit.with_audit(df, "a_dbt_backup").columns == ["a"]
    once = audit.with_audit(df, "t")
    assert once.columns == ["a", "t_crtd_id", "t_crtd_dt", "t_updt_id", "t_updt_dt", "t_table_id"]
    assert audit.with_audit(once, "t").columns == once.columns


def test_labels_are_inserted_once(frame):
    stored = frame([("c1", "1", True, "kept")], "course_id string, taxonomy_id string, hydrogen_related boolean, classification_note string")
    batch = frame([("c1", "1"), ("c1", "2")], "course_id string, taxonomy_id string")
    got = merge.save_course_taxonomy(stored, batch)
    assert rows(got) == [("c1", "1", True, "kept"), ("c1", "2", False, None)]
    assert rows(merge.save_course_taxonomy(got, batch)) == rows(got)


KEYS = st.tuples(st.integers(1, 4), st.integers(2020, 2022), st.integers(1, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(KEYS, st.integers(0, 99)), st.dictionaries(KEYS, st.integers(0, 99)))
def test_merge_properties(spark, stored, batch):
    schema = "unitid int, report_year int, student_level smallint, total_headcount int"
    make = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], schema)
    got = merge.upsert_enrollment(make(stored), make(batch))
    want = {**stored, **batch}
    assert {tuple(r)[:3]: r[3] for r in got.collect()} == want
    assert rows(merge.upsert_enrollment(got, make(batch))) == rows(got)


def test_hot_target_key_updates_every_row(spark):
    target = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', concat('s', id)) AS source_name", "id", "'old' AS source_type")
    batch = spark.createDataFrame([("hot", "new"), ("fresh", "new")], "source_name string, source_type string")
    got = merge.merge_table(target, batch, ["source_name"], update=["source_type"])
    assert got.count() == 3001
    assert got.filter("source_type = 'new' AND source_name = 'hot'").count() == 1000


# --- checks --------------------------------------------------------------------------------


def test_checks(frame):
    child = frame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = frame([("a",)], "id string")
    assert rows(checks.check_fk(child, "k", parent, "id")) == [("b", 2)]
    assert rows(checks.check_unique(child, ["k"])) == [("b", 2)]
    sources = frame([("1", "x" * 51, None), ("1", "ok", "directory-of-things")], "source_id string, source_name string, source_type string")
    assert rows(checks.check_columns(sources, schemas.SOURCES)) == [
        ("source_name", "too long", 1), ("source_type", "null", 1), ("source_type", "too long", 1),
    ]
    found = rows(checks.table_violations({"sources": sources.withColumn("source_distinct_id", F.lit("d")),
                                          "distinct_sources": frame([("e",)], "distinct_id string")}, "sources"))
    assert ("source_id", "repeated", 1) in found and ("source_distinct_id", "no parent", 2) in found


# --- repair --------------------------------------------------------------------------------


def test_cip_repair(frame):
    programs = frame([('="11.0101"', "A"), ("11.0101", "B"), ("n/a", "C"), (None, "D"), ("x", "E"), ("9.5", "F")],
                     "cipcode string, program_name string")
    facts = frame([("11.0101", 1), ('="09.5000"', 2), ("12.0000", 3), (None, 4), ("bad", 5)], "cipcode string, n int")
    kept, left = repair.repair_programs_and_facts(programs, facts)
    assert rows(kept) == [(Decimal("0.0000"), "D"), (Decimal("11.0101"), "B"), (Decimal("9.5000"), "F")]
    assert rows(left, "n", "cipcode") == [
        (1, Decimal("11.0101")), (2, Decimal("9.5000")), (4, Decimal("0.0000")), (5, Decimal("0.0000")),
    ]


def test_close_runs(frame):
    runs = frame([(1, "running", None), (2, "running", None)], "run_id int, run_status string, run_end_time timestamp")
    got = repair.close_runs(runs, frame([(2,), (2,), (9,)], "run_id int"), now())
    assert rows(got) == [(1, "running", None), (2, "finished", NOON)]


def test_delete_cascade(frame):
    tables = {
        "sources": frame([("1",), ("2",)], "source_id string"),
        "logs": frame([(1, "1"), (2, "2"), (3, None)], "log_id int, log_source_id string"),
        "urls": frame([("u", "1")], "url_id string, url_source_id string"),
        "courses": frame([("c1", "2"), ("c2", "2")], "course_id string, course_source_id string"),
        "course_taxonomy01": frame([("c1", "1"), ("c2", "1.1")], "course_id string, taxonomy_id string"),
        "course_keywords01": frame([("c1", "k"), ("c2", "k")], "course_id string, keyword_id string"),
        "taxonomy01": frame([("1",), ("1.1",)], "taxonomy_id string"),
        "keywords01": frame([("k",)], "keyword_id string"),
    }
    left = repair.delete_cascade(tables, "sources", frame([("1",)], "source_id string"))
    assert rows(left["sources"]) == [("2",)] and rows(left["logs"], "log_id") == [(2,), (3,)]
    assert rows(left["urls"]) == [("u", "1")]
    assert rows(repair.delete_blockers(tables, "sources", frame([("1",)], "source_id string"))) == [("urls", "1", 1)]
    left = repair.delete_cascade(tables, "courses", frame([("c1",)], "course_id string"))
    assert rows(left["course_taxonomy01"]) == [("c2", "1.1")] and rows(left["course_keywords01"]) == [("c2", "k")]
    left = repair.delete_cascade(tables, "taxonomy01", frame([("1.1",)], "taxonomy_id string"))
    assert rows(left["course_taxonomy01"]) == [("c1", "1")]
    left = repair.delete_cascade(tables, "keywords01", frame([("k",)], "keyword_id string"))
    assert rows(left["course_keywords01"]) == []


# --- history -------------------------------------------------------------------------------


def test_scd2(frame):
    schema = "k string, d string, x int"
    t0, t1 = (F.lit(f"2025-0{m}-01 00:00:00").cast("timestamp") for m in (1, 2))
    d0, d1 = datetime(2025, 1, 1), datetime(2025, 2, 1)
    first = history.start_history(frame([("a", None, 1), ("b", "t", 1), ("gone", "t", 1)], schema), t0)
    second = history.scd2(first, frame([("a", "text", 1), ("b", "t", 2), ("c", None, 1)], schema), "k", ["d"], t1)
    assert rows(second) == sorted([
        ("a", None, 1, d0, d1), ("a", "text", 1, d1, None), ("b", "t", 1, d0, None), ("c", None, 1, d1, None),
        ("gone", "t", 1, d0, None),
    ], key=lambda r: [(v is not None, str(v)) for v in r])
    # x is not watched, so b keeps its version; a rerun changes nothing
    again = history.scd2(second, frame([("a", "text", 1), ("b", "t", 2), ("c", None, 1)], schema), "k", ["d"], now())
    assert rows(again) == rows(second)
    with pytest.raises(PySparkException, match="several rows for key"):
        history.scd2(first, frame([("a", "1", 1), ("a", "2", 1)], schema), "k", ["d"], t1).collect()


def test_snapshot_key(frame):
    details = frame([("1.3", None), ("1", "T")], "taxonomy_id string, course_title string")
    assert rows(history.course_snapshot_rows(details), "history_key") == [("1-T",), ("1.3-",)]
    long = frame([("1", "t" * 400, "c1")], "taxonomy_id string, course_title string, course_id string")
    assert rows(history.course_snapshot_rows(long), "history_key") == [("1-" + "t" * 400,)]
    wide = history.course_snapshot_rows(long, ["taxonomy_id", "course_title", "course_id"])
    assert rows(wide, "history_key") == [("1-" + "t" * 400 + "-c1",)]


# --- schemas -------------------------------------------------------------------------------


def test_conform(frame):
    df = frame([("1", "5", "x", 7)], "course_id string, award_text string, name string, extra int")
    struct = schemas._struct(course_id="string", award_level="int", note="string")
    got = schemas.conform(df, struct, renames={"award_text": "award_level"})
    assert got.columns == ["course_id", "award_level", "note"] and rows(got) == [("1", 5, None)]
    assert schemas.conform(df, struct, {"award_text": "award_level"}, keep_extra=True).columns[-2:] == ["name", "extra"]


def test_conform_defaults_fill_absent_columns_only(frame):
    absent = frame([("u", "s", "l")], "url_id string, url_source_id string, url_link string")
    assert rows(schemas.conform(absent, schemas.URLS), "is_target") == [(True,)]
    present = frame([("u", "s", "l", None)], "url_id string, url_source_id string, url_link string, is_target boolean")
    assert rows(schemas.conform(present, schemas.URLS), "is_target") == [(None,)]
    labels = frame([("c", "1")], "course_id string, taxonomy_id string")
    assert rows(schemas.conform(labels, schemas.COURSE_TAXONOMY)) == [("c", "1", False, None)]


def test_require_batch(frame):
    with pytest.raises(ValueError, match="taxonomy_id"):
        schemas.require_batch(frame([("c",)], "course_id string"), "labels")
    got = schemas.require_batch(frame([("2020", 1, 2, "3")], "report_year string, unitid bigint, grtype int, grtotlt string"), "gradrates")
    assert got.schema == schemas.BATCHES["gradrates"]


def test_every_declared_reference_has_a_parent():
    for table in schemas.TABLES.values():
        for key, (parent, parent_key, _) in table.foreign_keys.items():
            assert key in table.names and parent_key in schemas.TABLES[parent].names


@pytest.mark.parametrize("seed", range(2))
def test_history_of_many_states_equals_one_after_the_other(frame, seed):
    import random

    rnd = random.Random(seed)
    schema = "k string, a string, b int, note string"
    states = [
        [(k, rnd.choice(["x", "y", None]), rnd.randint(0, 1), f"{k}{day}") for k in ["p", "q", "r", "s", None] if k != "s" or day % 3]
        for day in range(10)
    ]
    dated = frame([(f"2024-01-{day + 1:02} 00:00:00", *r) for day, rows_ in enumerate(states) for r in rows_], "day string, " + schema)
    got = history.from_states(dated.withColumn("day", F.col("day").cast("timestamp")), "k", "day", ["a", "b"])
    want = None
    for day, rows_ in enumerate(states):
        now, current = F.lit(f"2024-01-{day + 1:02} 00:00:00").cast("timestamp"), frame([r for r in rows_ if r[0]], schema)
        want = history.start_history(current, now) if want is None else history.scd2(want, current, "k", ["a", "b"], now)
    assert rows(got.filter("k IS NOT NULL"), *want.columns) == rows(want)
    assert got.filter("k IS NULL AND valid_to IS NULL").count() == 1
    with pytest.raises(Exception, match="several rows for key p"):
        history.from_states(dated.unionByName(dated.filter("k = 'p'").limit(1)), "k", "day", ["a"]).collect()
