"""Time the headline queries: ``BENCH_SF_DIR``, ``BENCH_CPUS``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checkset.queries import QUERIES  # noqa: E402
from edmart.session import build_session  # noqa: E402

HEADLINE = [
    "source_data_status",
    "current_progress_summary",
    "scraper_performance",
    "dashboard_scraper_performance",
    "courses_with_taxonomy",
    "match_sources",
    "similar_sources",
    "similar_universities",
    "aggregate_completions",
    "load_report",
    "merge_completions",
    "merge_enrollment",
    "merge_gradrates",
    "merge_courses",
    "drop_orphans",
    "new_sources_pipeline",
    "scd2_snapshot",
]

def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(build, repeats: int) -> float:
    """Median of warm runs, building the plan included."""
    run(build())
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        run(build())
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # call sites in error messages; costs planning time on the driver
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    queries = {name: timed(lambda: QUERIES[name](spark, sf_dir), repeats) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
