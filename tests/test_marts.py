"""Marts on hand-made tables: NULL handling, independent maxima, fan-out, hot sources."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edmart.operators import counts, logtimes, staging
from edmart.operators.audit import with_audit
from edmart.operators.normalise import normalise_sources
from edmart.plans import marts
from edmart.plans.views import register_views
from edmart.sources.tables import Tables
from tests.conftest import rows

LOGS = "log_id int, log_run_id int, log_source_id string, log_message string, log_ts timestamp"


def ts(text):
    return datetime.fromisoformat(f"2025-06-05 {text}")


@pytest.fixture
def tables(frame):
    sources = normalise_sources(frame([
        ("1", "Alpha src_1", "c", True, "https://a.org"),
        ("2", "Alpha src_2", "c", False, "https://a.org"),
        ("3", "Beta", "c", True, "https://b.org"),
        ("4", "Gamma", "c", True, None),
        ("5", "Delta", "c", False, None),
    ], "source_id string, source_name string, source_type string, is_enabled boolean, source_base_url string"))
    logs = frame([
        (1, 5, "1", "10 records scraped", ts("10:00:00")),
        (2, 9, "1", "7 records scraped", ts("09:00:00")),
        (3, 5, "3", "4 records scraped", ts("11:00:00")),
        (4, 5, "3", "scrape (slots left: 3)", ts("10:59:00")),
        (5, 5, "3", "scrape (slots left: 2)", ts("10:59:30")),
        (6, 5, "3", "no data found, scraping", ts("10:58:00")),
        (7, 6, "4", "crawling", ts("12:00:00")),
        (8, 6, "4", "still crawling", ts("12:00:00")),
        (9, 6, "4", "writing records to disk", ts("12:00:00")),
        (10, 6, "4", None, ts("12:00:00")),
        (11, 6, None, "9 records scraped", ts("13:00:00")),
        (12, 7, "2", "3 RECORDS SCRAPED", ts("09:30:00")),
    ], LOGS)
    return Tables({
        "sources": sources,
        "logs": logs,
        "urls": frame([("u1", "1"), ("u2", "2"), ("u3", "4"), ("u4", "zz")], "url_id string, url_source_id string"),
        "scraper_schemas": frame([("x", "3")], "scraper_schema_id string, scraper_schema_source_id string"),
        "courses": frame([
            ("c1", "1", "T", None), ("c2", "2", "T", None), ("c3", "1", "T", ""), ("c4", "1", None, None),
            ("c5", "3", "T", "d"),
        ], "course_id string, course_source_id string, course_title string, course_description string"),
        "runs": frame([(5, "finished", ts("08:00:00"), ts("14:00:00")), (6, "running", ts("11:30:00"), None)],
                      "run_id int, run_status string, run_start_time timestamp, run_end_time timestamp"),
    })


def test_source_data_status(tables):
    assert rows(marts.source_data_status(tables)) == [
        ("alpha", 0, 2, 3), ("beta", 1, 0, 1), ("delta", 0, 0, 0), ("gamma", 0, 1, 0),
    ]


def test_enabled_spine_counts_all_sources_of_the_name(tables):
    assert rows(marts.source_data_status_enabled(tables)) == [
        ("alpha", 2, 0, 2, 3), ("beta", 1, 1, 0, 1), ("gamma", 1, 0, 1, 0),
    ]


def test_null_name_meets_nothing(frame, tables):
    sources = tables.sources.withColumn("cleaned_name", F.when(F.col("source_id") != "4", F.col("cleaned_name")))
    out = marts.source_data_status_enabled(tables.with_tables(sources=sources))
    assert (None, 0, 0, 0, 0) in rows(out)


def test_progress(tables):
    got = rows(marts.current_progress_summary(tables), "school_name", "has_courses", "last_scrape_ts",
               "summary_status", "last_log", "run_id", "run_status")
    assert got == [
        ("alpha", 1, "2025-06-05 10:00", "Data Present", "10 records scraped", 5, "finished"),
        ("beta", 1, "2025-06-05 11:00", "Data Present", "4 records scraped", 5, "finished"),
        ("gamma", 0, "0", "Crawled, Pending Scrape", None, 6, "running"),
    ]
    assert marts.dashboard_data_summary(tables).columns == [
        "school_name", "source_count", "schema_count", "url_count", "course_count", "last_scrape_ts",
        "summary_status", "run_id", "run_status",
    ]


def test_latest_scrape_ignores_case_and_breaks_ties_by_id(frame, tables):
    got = rows(logtimes.latest_scrape(tables.logs, tables.sources), "school_name", "scraped_log_message")
    assert got == [("alpha", "10 records scraped"), ("beta", "4 records scraped")]
    only_two = tables.logs.filter("log_source_id = '2'")
    assert rows(logtimes.latest_scrape(only_two, tables.sources), "scraped_log_message") == [("3 RECORDS SCRAPED",)]


def test_status_ladder(frame):
    df = frame([(1, None, 0, 0), (0, ts("10:00:00"), 1, 1), (0, None, 1, 1), (0, None, 0, 1), (0, None, 0, 0)],
               "c int, t timestamp, u int, s int")
    got = [r[0] for r in df.select(marts.summary_status(F.col("c"), F.col("t"), F.col("u"), F.col("s"))).collect()]
    assert got == ["Data Present", "Scraped, No Courses", "Crawled, Pending Scrape", "Schema Generated", "Pending"]


def test_scrape_complete_takes_independent_maxima(tables):
    got = rows(logtimes.scrape_complete(tables.sources, tables.logs, fallback=False))
    assert got == sorted([
        ("1", ts("10:00:00"), 9), ("2", None, None), ("3", ts("11:00:00"), 5), ("4", None, None), ("5", None, None),
    ], key=str)
    with_fallback = dict((r[0], r[1:]) for r in rows(logtimes.scrape_complete(tables.sources, tables.logs)))
    assert with_fallback["2"] == (ts("09:30:00"), 7)
    assert with_fallback["4"] == (ts("12:00:00"), 6)
    assert with_fallback["5"] == (None, None)


def test_scraper_performance_rows(tables):
    got = rows(marts.scraper_performance(tables), "source_name", "run_id", "extracted_count", "slots_left",
               "url_count", "course_count", "courses_extracted_ts")
    assert got == [
        # newest message is of run 5 but the largest run is 9: no end log, and run 9 is unknown
        ("Alpha src_1", None, None, None, 1, 3, "Jun  5 2025 10:00AM"),
        ("Alpha src_2", None, 3, None, 1, 1, "Jun  5 2025  9:30AM"),
        ("Beta", 5, 4, 2, None, 1, "Jun  5 2025 11:00AM"),
        ("Beta", 5, 4, 3, None, 1, "Jun  5 2025 11:00AM"),
        ("Delta", None, None, None, None, None, None),
        # fallback without a completion message: two messages at the last time, the one being written and the NULL one do not count
        ("Gamma", 6, None, None, 1, None, None),
        ("Gamma", 6, None, None, 1, None, None),
    ]


def test_dashboard_rows(tables):
    got = rows(marts.dashboard_scraper_performance(tables), "source_name", "start_scrape_ts", "end_scrape_ts",
               "scrape_time_hh_mm_ss", "slots_left")
    assert ("Beta", "2025-06-05 10-58", "2025-06-05 11-00", "00:02:00", 3) in got
    assert ("Beta", "2025-06-05 10-58", "2025-06-05 11-00", "00:02:00", 2) in got
    assert ("Gamma", None, None, None, None) in got
    assert len(got) == 6


def test_hot_slots_messages_are_all_kept(spark, tables):
    """Thousands of slots messages of one run and source: salted, none lost, none invented."""
    n = 5000
    hot = spark.range(n).select(
        (F.col("id") + 1000).cast("int").alias("log_id"), F.lit(5).alias("log_run_id"), F.lit("3").alias("log_source_id"),
        F.concat(F.lit("scrape (slots left: "), F.col("id").cast("string"), F.lit(")")).alias("log_message"),
        F.lit(ts("10:00:00")).alias("log_ts"),
    )
    out = marts.scraper_performance(tables.with_tables(logs=tables.logs.unionByName(hot)))
    beta = out.filter("source_name = 'Beta'")
    assert beta.count() == n + 2
    assert beta.select("slots_left").distinct().count() == n
    assert out.filter("source_name = 'Delta'").count() == 1


def test_fan_out_form_equals_conditional_maxima(spark, tables):
    tables.sources.createOrReplaceTempView("fs")
    tables.logs.createOrReplaceTempView("fl")
    plain = spark.sql("""SELECT s.source_id, coalesce(max(l.log_ts), max(b.log_ts)), coalesce(max(l.log_run_id), max(b.log_run_id))
      FROM fs s LEFT JOIN fl l ON s.source_id = l.log_source_id AND l.log_message LIKE '%records scraped%'
      LEFT JOIN fl b ON s.source_id = b.log_source_id GROUP BY s.source_id""")
    assert rows(logtimes.scrape_complete(tables.sources, tables.logs)) == rows(plain)


def test_courses_with_taxonomy(frame, tables):
    t = tables.with_tables(
        taxonomy01=frame([("1", "One"), ("1.1", "Sub")], "taxonomy_id string, taxonomy_description string"),
        course_taxonomy01=frame([("c1", "1"), ("c5", "1.1"), ("zz", "1"), ("c2", "9")], "course_id string, taxonomy_id string"),
    )
    assert rows(marts.courses_with_taxonomy(t)) == [("1", "One", "T", None, "alpha"), ("1.1", "Sub", "T", "d", "beta")]


def test_point_reads(frame, tables):
    courses = tables.courses.withColumns({"course_code": F.lit("x"), "course_credits": F.lit("3")})
    assert rows(staging.course_data(courses, tables.sources, "1"), "course_id") == [("c1",), ("c3",), ("c4",)]
    urls = tables.urls.withColumns({"is_target": F.col("url_id") != "u2", "url_link": F.col("url_id")})
    assert rows(staging.target_urls(urls, tables.sources), "url_link") == [("u1",), ("u3",)]
    assert rows(staging.target_urls(urls, tables.sources, "4"), "url_link") == [("u3",)]
    assert rows(staging.target_urls(urls, tables.sources, "zz")) == []


def test_views(spark, frame, tables):
    t = tables.with_tables(courses=with_audit(tables.courses.withColumn("course_code", F.lit("x")), "courses"))
    made = register_views(t, ["stg_sources", "stg_courses", "current_progress_summary", "stg_taxonomies"])
    assert made == ["stg_sources", "stg_courses", "current_progress_summary"]
    got = spark.sql("SELECT school_name FROM current_progress_summary WHERE has_courses = 1 ORDER BY 1").collect()
    assert [r[0] for r in got] == ["alpha", "beta"]
    assert spark.table("stg_courses").columns[-1] == "courses_table_id"
    with pytest.raises(KeyError):
        register_views(t, ["no_such_view"])


def test_staged_marts_equal_lazy_ones(spark, tables, tmp_path):
    lazy = rows(marts.scraper_performance(tables))
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert rows(marts.scraper_performance(tables, stage=True)) == lazy


def test_counts_are_taken_before_the_join(tables):
    plan = counts.school_counts(tables.sources, tables.scraper_schemas, tables.urls)._jdf.queryExecution().optimizedPlan().toString()
    # the only join sees aggregated children
    assert plan.count("Join ") == 1 and plan.count("Aggregate [source_id") == 1
