"""Partial results by day: marts on them equal marts on all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edmart.operators import counts, logtimes, rollup
from edmart.operators.normalise import normalise_sources
from edmart.plans import marts
from edmart.sources.tables import Tables
from tests.conftest import rows

LOGS = "log_id int, log_run_id int, log_source_id string, log_message string, log_ts timestamp"
MESSAGES = (
    "10 records scraped", "3 Records Scraped", "no data found, scraping", "scrape (slots left: 4)",
    "writing records", "crawling", None,
)
START = datetime(2025, 6, 5)


def random_logs(seed, n=400):
    """Few distinct times, runs that complete late or never, one hot source, NULLs in every column but the id."""
    pick = random.Random(seed)
    out = []
    for i in range(n):
        day = pick.randrange(4)
        time = START + timedelta(days=day, hours=pick.randrange(3)) if pick.random() < 0.95 else None
        source = "1" if pick.random() < 0.4 else pick.choice(["2", "3", "4", "5", "99", None])
        run = pick.choice([day * 2, day * 2 + 1, pick.randrange(8), None])
        out.append((i, run, source, pick.choice(MESSAGES), time))
    return out + [(n, None, "6", "crawling", None), (n + 1, 3, "7", "scrape (slots left: 1)", None)]


@pytest.fixture
def base(frame):
    sources = normalise_sources(frame(
        [(str(k), f"School {k % 4} src_{k}", "c", k != 5, "https://a.org") for k in range(1, 8)],
        "source_id string, source_name string, source_type string, is_enabled boolean, source_base_url string",
    ))
    courses = frame(
        [("1", "a", "x"), ("1", "a", "x"), ("2", "a", "x"), ("2", None, "x"), ("3", "", "x"), ("3", None, None), (None, "b", "y")],
        "course_source_id string, course_title string, course_description string",
    ).withColumn("course_id", F.monotonically_increasing_id().cast("string"))
    return Tables({
        "sources": sources, "courses": courses,
        "runs": frame([(k, "done", START, None) for k in range(8)],
                      "run_id int, run_status string, run_start_time timestamp, run_end_time timestamp"),
        "urls": frame([(1, "1", "u")], "url_id int, url_source_id string, url_link string"),
        "scraper_schemas": frame([(1, "2", "{}")], "scraper_schema_id int, scraper_schema_source_id string, scraper_schema_json string"),
    })


def all_marts(t):
    built = (marts.current_progress_summary, marts.scraper_performance, marts.dashboard_scraper_performance)
    out = [rows(build(t)) for build in built]
    return out + [rows(logtimes.latest_scrape(t.logs, t.sources)), rows(logtimes.latest_log(t.logs, t.sources))]


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_from_days_equal_marts_from_all_rows(spark, frame, base, tmp_path, seed):
    logs = frame(random_logs(seed), LOGS)
    store = str(tmp_path / "logs")
    day = F.to_date("log_ts")
    rollup.fold_logs(logs.filter(day.isNull() | (day <= F.lit(START + timedelta(days=1)))), store)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "logs" / "log_period=2025-06-05").glob("*.parquet")}
    for _ in range(2):  # the second day again, and the later ones; a replay changes nothing
        rollup.fold_logs(logs.filter(day >= F.lit(START + timedelta(days=1))), store)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "logs" / "log_period=2025-06-05").glob("*.parquet")} == before
    rollup.fold_courses(base.courses.filter("course_source_id <= '2'"), str(tmp_path / "courses"), "a")
    for _ in range(2):
        rollup.fold_courses(base.courses.filter("NOT coalesce(course_source_id <= '2', false)"), str(tmp_path / "courses"), "b")
    kept = rollup.folded_logs(spark, store, logs)
    assert kept.columns == logs.columns and kept.count() < logs.count()
    digests = rollup.folded_courses(spark, str(tmp_path / "courses"))
    want = all_marts(base.with_tables(logs=logs))
    assert all_marts(base.with_tables(logs=kept, course_digests=digests)) == want
    assert all_marts(base.with_tables(logs=rollup.needed_logs(kept))) == want


def test_course_digests_count_like_texts(base, frame):
    digests = rollup.course_digests(base.courses)
    want = rows(counts.distinct_course_counts(base.courses, base.sources))
    assert rows(counts.distinct_digest_counts(digests, base.sources)) == want
    assert digests.agg(F.sum("n")).first()[0] == base.courses.count()


def test_needed_logs_of_a_long_run_are_few(frame):
    logs = frame([(i, 1, "1", "crawling", START + timedelta(seconds=i)) for i in range(1000)], LOGS)
    assert rows(rollup.needed_logs(logs), "log_id") == [(999,)]
    assert rollup.needed_logs(logs.limit(0)).count() == 0


def test_slots_messages_of_older_runs_go(frame):
    logs = frame([
        (1, 1, "1", "scrape (slots left: 1)", START), (2, 1, "1", "5 records scraped", START + timedelta(hours=1)),
        (3, 2, "1", "scrape (slots left: 2)", START + timedelta(hours=2)),
        (4, 2, "1", "6 records scraped", START + timedelta(hours=3)),
        (5, 3, "1", "scrape (slots left: 3)", START + timedelta(hours=4)), (6, 3, "1", "x", START + timedelta(hours=5)),
    ], LOGS)
    assert rows(rollup.needed_logs(logs), "log_id") == [(2,), (3,), (4,), (5,), (6,)]


def test_empty_store(spark, frame, tmp_path):
    logs = frame([], LOGS)
    rollup.fold_logs(logs, str(tmp_path / "logs"))
    assert rollup.folded_logs(spark, str(tmp_path / "logs"), logs).count() == 0
