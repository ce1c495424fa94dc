"""Run registered queries in Spark and DuckDB and compare the rows.

``python -m checkset.compare [--no-broadcast] [dir] [name...]``; without broadcast every
join takes its shuffled form.
"""

from __future__ import annotations

import collections
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checkset.queries import ORACLES, QUERIES
from checkset.standins import BASE_TABLES
from edmart.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(r[i] for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return True, f"{sum(got.values())} rows, no SQL"
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    want = rows_of(columns, cur.fetchall())
    if got == want:
        return True, f"{sum(got.values())} rows"
    return False, (
        f"{sum(got.values())} / {sum(want.values())} rows; only Spark {list((got - want).items())[:3]}; "
        f"only SQL {list((want - got).items())[:3]}"
    )


def main(argv: list[str]) -> int:
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if "--no-broadcast" in argv:
        argv = [a for a in argv if a != "--no-broadcast"]
        settings["spark.sql.autoBroadcastJoinThreshold"] = "-1"
        settings["spark.sql.adaptive.autoBroadcastJoinThreshold"] = "-1"
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("checkset", "local[8]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the other queries
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {note[:900]}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
