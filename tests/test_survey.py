"""Survey folders, row validity, counters and load jobs."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from edmart import schemas
from edmart.operators import merge, validate
from edmart.plans import loads
from edmart.sources import survey, tables
from tests.conftest import rows


@pytest.fixture
def units(frame):
    return frame([(1, "One"), (2, "Two")], "unitid int, instnm string")


@pytest.fixture
def programs(frame):
    return frame([(Decimal("11.0101"),), (Decimal("11.0102"),)], "cipcode decimal(10,4)")


@pytest.fixture
def folder(spark, tmp_path):
    """Two sub-folders ("databases") with survey tables as directories of part files."""

    def put(database, name, data, schema, files=1):
        spark.createDataFrame(data, schema).repartition(files).write.parquet(f"{tmp_path}/{database}/{name}.parquet")

    put("a", "GR2021", [(1, 2, 10, "x"), (2, 2, 11, "x"), (9, 2, 12, "x"), (1, 3, None, "x"), (None, 3, 1, "x")],
        "UNITID int, GRTYPE int, GRTOTLT int, OTHER string", files=3)
    put("b", "gr2022", [("1", "2", "20"), ("2", "x", "5")], "unitid string, GrType string, grtotlt string")
    put("b", "GR2020", [(1, 2)], "UNITID int, GRTYPE int")
    put("b", "GR2022_L2", [(1, 2, 3)], "UNITID int, GRTYPE int, GRTOTLT int")
    put("b", "~GR2019", [(1, 2, 3)], "UNITID int, GRTYPE int, GRTOTLT int")
    put("b", "MSysGR", [(1,)], "UNITID int")
    put("a", "EFFY2021", [(1, 1, 100), (1, 1, 50), (2, None, 3), (8, 1, 1)], "UNITID int, EFFYALEV int, EFYTOTLT int")
    put("a", "C2021_A", [
        (1, '="11.0101"', 3, 5), (1, "11.0101", 3, 6), (1, "11.01015", 3, 7), (1, '="x"', 3, 1), (1, "11.0101", 1, 1),
        (1, "11.0101", 16, 1), (7, "11.0101", 3, 1), (2, "11.0102", 21, 0), (2, "11.0102", 21, -1), (2, "11.0102", 21, None),
        (2, None, 3, 2),
    ], "UNITID int, CIPCODE string, AWLEVEL int, CTOTALT int")
    put("b", "C2022_A", [(1, "11.0101", 3, 9)], "UNITID int, CIPCODE string, AWLEVEL int, CTOTALT int")
    return str(tmp_path)


def test_scan_tables_and_years(spark, folder):
    scan = survey.scan_survey(spark, folder, "GR")
    assert sorted(scan.tables, key=str) == [
        ("GR2020", 2020, survey.MISSING_COLUMNS), ("GR2021", 2021, survey.READ),
        ("GR2022_L2", None, survey.NON_STANDARD), ("gr2022", 2022, survey.READ),
    ]
    assert scan.years == [2021, 2022]
    assert rows(scan.rows, "report_year", "unitid", "grtype", "grtotlt", "unreadable") == sorted([
        (2021, 1, 2, 10, False), (2021, 2, 2, 11, False), (2021, 9, 2, 12, False), (2021, 1, 3, None, False),
        (2021, None, 3, 1, False), (2022, 1, 2, 20, False), (2022, 2, None, 5, True),
    ], key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(survey.scan_report(spark, scan)) == sorted(scan.tables, key=lambda r: [(v is not None, str(v)) for v in r])
    assert survey.scan_survey(spark, folder, "GR", years=[2022]).years == [2022]


def test_completions_scan_does_not_report_other_names(spark, folder):
    assert {t[0] for t in survey.scan_survey(spark, folder, "C_A").tables} == {"C2021_A", "C2022_A"}


def test_files_of_any_name_and_partition_folders(spark, tmp_path):
    schema = "UNITID int, GRTYPE int, GRTOTLT int"
    one = lambda n: spark.createDataFrame([(n, 2, n)], schema).coalesce(1)
    one(1).write.parquet(f"{tmp_path}/raw/t1")
    part = next((tmp_path / "raw" / "t1").glob("part-*.parquet"))
    for place in ("GR2020/data_0.parquet", "GR2021/x.PARQUET", "GR2024.Parquet", "GRTYPES/GR2025/a/b.parquet", "misc/notes.parquet"):
        (tmp_path / "in" / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / place).write_bytes(part.read_bytes())
    one(3).write.partitionBy("GRTYPE").parquet(f"{tmp_path}/in/GR2022")
    scan = survey.scan_survey(spark, str(tmp_path / "in"), "GR")
    assert rows(scan.rows, "report_year", "unitid", "grtype", "grtotlt") == [
        (2020, 1, 2, 1), (2021, 1, 2, 1), (2022, 3, 2, 3), (2024, 1, 2, 1), (2025, 1, 2, 1),
    ]
    assert ("notes", None, survey.NO_SURVEY) in scan.tables
    assert survey.scan_survey(spark, f"file://{tmp_path}/in", "GR").years == [2020, 2021, 2022, 2024, 2025]


def test_year_filter_prunes_tables_and_columns(spark, folder):
    df = survey.scan_survey(spark, folder, "GR").rows.filter("report_year = 2022").select("unitid")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GR2021" not in plan
    assert "ReadSchema: struct<unitid:string>" in plan


def test_csv_tables(spark, tmp_path, units):
    (tmp_path / "EFFY2020.csv").write_text("unitid,EFFYALEV,efytotlt,more\n1,1,10,a\n2,1,n/a,b\n")
    (tmp_path / "EFFY_D.csv").write_text("a\n1\n")
    scan = survey.scan_survey(spark, str(tmp_path), "EFFY", format="csv")
    assert rows(scan.rows, "report_year", "unitid", "total_headcount", "unreadable") == [
        (2020, 1, 10, False), (2020, 2, None, True),
    ]
    assert ("EFFY_D", None, survey.NON_STANDARD) in scan.tables
    report = validate.measures_report(scan.rows, units, ["student_level", "total_headcount"])
    assert rows(report, "extracted", "skipped") == [(1, 1)]


def test_empty_folder(spark, tmp_path):
    scan = survey.scan_survey(spark, str(tmp_path), "C_A")
    assert scan.tables == [] and scan.rows.count() == 0 and "cipcode" in scan.rows.columns


def test_gradrates_load(spark, folder, units, frame):
    target = frame([(1, 2021, 1, 2, 3), (2, 2019, 1, 2, 4)],
                   "graduationrate_id bigint, report_year int, unitid int, grtype smallint, grtotlt int")
    load = loads.load_gradrates(spark, folder, units, target)
    assert rows(load.facts, "report_year", "unitid", "grtype", "grtotlt") == [
        (2019, 1, 2, 4), (2021, 1, 2, 10), (2021, 2, 2, 11), (2022, 1, 2, 20),
    ]
    # a known university without a measure is counted nowhere, an unreadable value is skipped
    assert rows(load.report) == [("GR2021", 2021, 2, 2), ("gr2022", 2022, 1, 1)]


def test_enrollment_load_fails_or_sums_duplicates(spark, folder, units, frame):
    target = frame([], "enrollment_id bigint, report_year int, unitid int, student_level smallint, total_headcount int")
    with pytest.raises(PySparkException, match="several rows for key"):
        loads.load_enrollment(spark, folder, units, target).facts.collect()
    load = loads.load_enrollment(spark, folder, units, target, on_duplicate="sum")
    assert rows(load.facts, "report_year", "unitid", "student_level", "total_headcount") == [(2021, 1, 1, 150)]
    assert rows(load.report) == [("EFFY2021", 2021, 2, 1)]
    with pytest.raises(ValueError):
        loads.load_enrollment(spark, folder, units, target, on_duplicate="last")


def test_completions_load(spark, folder, units, programs, frame):
    target = frame([(7, 2022, 1, Decimal("11.0101"), 3, 1)],
                   "completion_id bigint, report_year int, unitid int, cipcode decimal(10,4), award_level int, total_completions int")
    load = loads.load_completions(spark, folder, units, programs, target)
    assert rows(load.facts, "report_year", "unitid", "cipcode", "award_level", "total_completions") == [
        (2021, 1, Decimal("11.0101"), 3, 11), (2021, 2, Decimal("11.0102"), 21, 0), (2022, 1, Decimal("11.0101"), 3, 9),
    ]
    assert rows(load.report) == [("C2021_A", 2021, 3, 8), ("C2022_A", 2022, 1, 0)]


def test_early_sums_equal_sums_of_valid_rows(spark, folder, units, programs):
    raw = survey.scan_survey(spark, folder, "C_A").rows
    late = validate.aggregate_completions(validate.valid_completions(raw, units, programs))
    assert rows(late) == rows(validate.completions_batch(raw, units, programs))


@pytest.mark.parametrize("year", [2020, None])
def test_upsert_years_fails_on_a_row_of_another_year(spark, frame, tmp_path, year):
    path = str(tmp_path / "facts")
    schema = schemas.ENROLLMENT.struct
    spark.createDataFrame([], schema).write.partitionBy(*schemas.ENROLLMENT.partition_by).parquet(path)
    batch = frame([(2021, 1, 1, 5), (year, 1, 1, 6)], "report_year int, unitid int, student_level smallint, total_headcount int")
    with pytest.raises(PySparkException, match="unlisted report year"):
        loads.upsert_years(spark, path, schemas.ENROLLMENT, merge.upsert_enrollment, batch, [2021])


def test_upsert_years_rewrites_only_touched_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "facts")
    schema = schemas.ENROLLMENT.struct
    stored = frame([(1, 2020, 1, 1, 5), (2, 2021, 1, 1, 6), (3, 2021, 2, 1, 7)], schema)
    tables.save_table(stored, path, "enrollment_fact")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "facts" / "report_year=2020").glob("*.parquet")}
    batch = frame([(2021, 1, 1, 60), (2021, 9, 1, 1), (2022, 1, 1, 8)],
                  "report_year int, unitid int, student_level smallint, total_headcount int")
    for _ in range(2):  # the second run changes nothing
        loads.upsert_years(spark, path, schemas.ENROLLMENT, merge.upsert_enrollment, batch, [2021, 2022])
        got = spark.read.schema(schema).parquet(path)
        assert rows(got, "report_year", "unitid", "total_headcount") == [
            (2020, 1, 5), (2021, 1, 60), (2021, 2, 7), (2021, 9, 1), (2022, 1, 8),
        ]
        assert got.select("enrollment_id").distinct().count() == 5
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "facts" / "report_year=2020").glob("*.parquet")} == before


def test_facts_are_rebalanced_by_year(spark, frame):
    df = frame([(1, 2020, 1, 1, 5)], schemas.ENROLLMENT.struct)
    plan = tables.by_partition(df, schemas.ENROLLMENT)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_load_with_a_checkpoint_folder(spark, folder, units, programs, frame, tmp_path_factory):
    target = frame([], "completion_id bigint, report_year int, unitid int, cipcode decimal(10,4), award_level int, total_completions int")
    plain = loads.load_completions(spark, folder, units, programs, target)
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    load = loads.load_completions(spark, folder, units, programs, target)
    plan = load.batch._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Aggregate" not in plan
    assert rows(load.facts.drop("completion_id")) == rows(plain.facts.drop("completion_id"))


def test_files_of_any_name_and_partition_folders(spark, tmp_path):
    schema = "UNITID int, GRTYPE int, GRTOTLT int"
    one = lambda n: spark.createDataFrame([(n, 2, n)], schema).coalesce(1)
    one(1).write.parquet(f"{tmp_path}/raw/t1")
    part = next((tmp_path / "raw" / "t1").glob("part-*.parquet"))
    for place in ("GR2020/data_0.parquet", "GR2021/x.PARQUET", "GR2024.Parquet", "GRTYPES/GR2025/a/b.parquet", "misc/notes.parquet"):
        (tmp_path / "in" / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / place).write_bytes(part.read_bytes())
    one(3).write.partitionBy("GRTYPE").parquet(f"{tmp_path}/in/GR2022")
    scan = survey.scan_survey(spark, str(tmp_path / "in"), "GR")
    assert rows(scan.rows, "report_year", "unitid", "grtype", "grtotlt") == [
        (2020, 1, 2, 1), (2021, 1, 2, 1), (2022, 3, 2, 3), (2024, 1, 2, 1), (2025, 1, 2, 1),
    ]
    assert ("notes", None, survey.NO_SURVEY) in scan.tables
    assert survey.scan_survey(spark, f"file://{tmp_path}/in", "GR").years == [2020, 2021, 2022, 2024, 2025]


def test_year_filter_prunes_fact_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "facts")
    tables.save_table(frame([(1, 2020, 1, 1, 5), (2, 2021, 1, 1, 6)], schemas.ENROLLMENT.struct), path, "enrollment_fact")
    plan = spark.read.parquet(path).filter("report_year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_year" in plan


def test_seeds_tables_and_marts(spark, frame, tmp_path):
    stages = tables.load_seed(spark, "log_stages")
    assert rows(stages)[0] == (0, "crawl") and stages.count() == 5
    assert tables.load_seed(spark, "log_stages", into=stages).count() == 5
    csv = tmp_path / "taxonomy.csv"
    csv.write_text('taxonomy_id,taxonomy_description\n1,"A ""quoted"" root"\n1.1,Leaf\n')
    into = frame([("1", "stored")], "taxonomy_id string, taxonomy_description string")
    assert rows(tables.load_seed(spark, "taxonomy01", str(csv), into)) == [("1", "stored"), ("1.1", "Leaf")]
    assert rows(tables.load_seed(spark, "taxonomy01", str(csv)))[0] == ("1", 'A "quoted" root')
    with pytest.raises(ValueError):
        tables.load_seed(spark, "taxonomy01")
    into.write.parquet(str(tmp_path / "db" / "taxonomy01"))
    loaded = tables.Tables.load(spark, str(tmp_path / "db"), ["taxonomy01"], views=True)
    assert rows(loaded.taxonomy01) == rows(spark.table("taxonomy01")) == [("1", "stored")]
    with pytest.raises(AttributeError):
        loaded.nothing
    mart = tables.save_mart(into.withColumn("n", F.lit(1)), "mart_view", str(tmp_path / "mart"))
    assert rows(mart) == rows(spark.table("mart_view")) == [("1", "stored", 1)]


def test_stored_tables_get_their_declared_types(spark, frame, tmp_path):
    frame([("1", 1, "a")], "taxonomy_id string, extra int, taxonomy_description string").write.parquet(str(tmp_path / "taxonomy01"))
    loaded = tables.Tables.load(spark, str(tmp_path), ["taxonomy01"]).taxonomy01
    assert loaded.columns[-1] == "extra" and set(schemas.TABLES["taxonomy01"].struct.names) <= set(loaded.columns)
    frame([(1, 2**40)], "run_status int, run_id bigint").write.parquet(str(tmp_path / "runs"))
    with pytest.raises(ValueError, match="run_id is bigint, declared int"):
        tables.Tables.load(spark, str(tmp_path), ["runs"])


def test_versions_read_as_the_newest(spark, frame, tmp_path):
    path, table = str(tmp_path / "runs"), schemas.TABLES["runs"]
    frame([(1, "done", 7)], "run_id int, state string, host int").write.parquet(f"{path}/version=1")
    frame([(3, "open")], "run_id smallint, run_status string").write.parquet(f"{path}/version=3")
    steps = {1: schemas.Step(renames={"state": "run_status"}, drops=("host",)), 2: schemas.Step()}
    got = tables.load_versions(spark, path, table, steps, newest=3)
    assert got.columns == table.struct.names
    assert rows(got, "run_id", "run_status") == [(1, "done"), (3, "open")]


def test_batch_and_counters_come_from_one_reading(spark, folder, units, programs, frame):
    target = frame([], "completion_id bigint, report_year int, unitid int, cipcode decimal(10,4), award_level int, total_completions int")
    load = loads.load_completions(spark, folder, units, programs, target)
    grades = frame([], "graduationrate_id bigint, report_year int, unitid int, grtype smallint, grtotlt int")
    rates = loads.load_gradrates(spark, folder, units, grades)
    for df in (load.batch, load.report, load.facts, rates.batch, rates.report, rates.facts):
        assert not [f for f in df.inputFiles() if folder in f]
    raw = survey.scan_survey(spark, folder, "C_A").rows
    assert rows(load.report) == rows(validate.completions_report(raw, units, programs))
    assert rows(load.batch.select(*validate.COMPLETION_KEYS, "total_completions")) == rows(
        validate.completions_batch(raw, units, programs).select(*validate.COMPLETION_KEYS, "total_completions")
    )
