"""Yearly survey tables in a folder: ``GRyyyy``, ``EFFYyyyy``, ``Cyyyy_A``.

A table is a file (``GR2022.parquet``, ``GR2022.csv``) or a directory of files
with that name, anywhere under the folder; the report year comes from the name, so it is a constant per branch and a filter on it drops whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Survey:
    """One kind of survey table; ``columns`` maps raw names to (name, type)."""

    pattern: str
    columns: dict[str, tuple[str, str]]
    prefix: str | None  # names with this prefix that fail the pattern are reported


# Table-name patterns and the columns read from them.
SURVEYS: dict[str, Survey] = {
    "GR": Survey(
        r"^GR(\d{4})$",
        {"UNITID": ("unitid", "int"), "GRTYPE": ("grtype", "int"), "GRTOTLT": ("grtotlt", "int")},
        "GR",
    ),
    "EFFY": Survey(
        r"^EFFY(\d{4})$",
        {"UNITID": ("unitid", "int"), "EFFYALEV": ("student_level", "int"), "EFYTOTLT": ("total_headcount", "int")},
        "EFFY",
    ),
    "C_A": Survey(
        r"^C(\d{4})_A$",
        {
            "UNITID": ("unitid", "int"),
            "CIPCODE": ("cipcode", "string"),
            "AWLEVEL": ("award_level", "int"),
            "CTOTALT": ("total_completions", "int"),
        },
        None,
    ),
}

# Names of system and temporary tables.
SKIPPED_PREFIXES = ("MSys", "~")

READ, MISSING_COLUMNS, NON_STANDARD, NO_SURVEY = "read", "missing columns", "non-standard name", "no survey table"


@dataclass(frozen=True)
class SurveyScan:
    """Rows of the accepted tables, and what became of every table looked at."""

    rows: DataFrame
    tables: list[tuple[str, int | None, str]]  # (table name, year, outcome)
    years: list[int]


def list_tables(spark: SparkSession, directory: str, format: str = "parquet") -> list[tuple[str, str]]:
    """(table name, path) of every user table under ``directory``.

    A file belongs to the deepest folder or file name above it that names a survey
    table, so part files may have any name and lie in partition folders. Files without such a name are
    tables of their own, part files of the folder they lie in. The
    driver only sees one row per table; contents are not read. The file
    extension is compared ignoring case.
    """
    any_case = "".join(f"[{c.lower()}{c.upper()}]" for c in format)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{any_case}")
        .load(directory)
        .select("path")
    )
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", directory).rstrip("/") + "/"
    files = files.withColumn("at", F.instr("path", plain) + len(plain))
    files = files.select("path", "at", F.expr("substring(path, at, length(path))").alias("below"))
    survey_name = "|".join(s.pattern.strip("^$").replace("(", "(?:") for s in SURVEYS.values())
    # folders in between count as part of the table's path, up to those that hold partition values
    table = rf"(?i)^((?:.*/)?({survey_name})(?:\.[a-z]+)?(?:/[^/=]+(?=/))*)(?:/|$)"
    named, name = F.regexp_extract("below", table, 1), F.regexp_extract("below", table, 2)
    is_part = F.startswith(F.substring_index("below", "/", -1), F.lit("part-")) & F.contains("below", F.lit("/"))
    other = F.when(is_part, F.regexp_replace("below", "/[^/]*$", "")).otherwise(F.col("below"))
    own = F.when(named != "", named).otherwise(other)
    stem = F.regexp_extract(other, r"([^/]*?)(\.[A-Za-z]+)?$", 1)
    tables = files.select(
        F.when(named != "", name).otherwise(stem).alias("name"), F.concat(F.expr("substring(path, 1, at - 1)"), own).alias("path")
    )
    listed = tables.distinct()
    found = [(r["name"], r["path"]) for r in listed.collect()]
    return sorted(t for t in found if not t[0].startswith(SKIPPED_PREFIXES))


def _typed(raw: Column, type_name: str) -> Column:
    return raw.cast("string") if type_name == "string" else raw.try_cast(type_name)


def typed_rows(df: DataFrame, survey: Survey, constants: dict[str, object] | None = None) -> DataFrame:
    """Survey columns (found ignoring case) with their names and types.

    ``unreadable`` marks rows where a present value does not read as its type.
    """
    raw = {c.upper(): F.col(c) for c in df.columns}
    out = [F.lit(v).alias(n) for n, v in (constants or {}).items()]
    bad = F.lit(False)
    for source_name, (name, type_name) in survey.columns.items():
        value = _typed(raw[source_name], type_name)
        out.append(value.alias(name))
        bad = bad | (raw[source_name].isNotNull() & value.isNull())
    return df.select(*out, bad.alias("unreadable"))


def _empty_rows(spark: SparkSession, survey: Survey) -> DataFrame:
    names = ", ".join(f"{n} {t}" for n, t in survey.columns.values())
    return spark.createDataFrame([], f"table_name string, report_year int, {names}, unreadable boolean")


def scan_survey(
    spark: SparkSession,
    directory: str,
    kind: str,
    format: str = "parquet",
    years: Iterable[int] | None = None,
) -> SurveyScan:
    """All rows of one kind of survey table under ``directory``.

    ``years`` limits the scan to those report years before any file is opened.
    """
    reader = spark.read.option("header", "true") if format == "csv" else spark.read
    named = [(name, lambda path=path: reader.format(format).load(path)) for name, path in list_tables(spark, directory, format)]
    return assemble(spark, named, kind, years)


def assemble(
    spark: SparkSession,
    named: Iterable[tuple[str, Callable[[], DataFrame]]],
    kind: str,
    years: Iterable[int] | None = None,
) -> SurveyScan:
    """The rows of one kind of survey from named tables, each opened only if its name and year fit.

    A table that lacks a required column is skipped whole. Tables that belong to no
    survey at all are reported, those of another survey are not.
    """
    survey = SURVEYS[kind]
    wanted = None if years is None else set(years)
    frames, outcome, read_years = [], [], set()
    for name, open_table in named:
        match = re.match(survey.pattern, name, re.IGNORECASE)
        if match is None:
            if survey.prefix and name.upper().startswith(survey.prefix):
                outcome.append((name, None, NON_STANDARD))
            elif not any(
                re.match(s.pattern, name, re.IGNORECASE) or (s.prefix and name.upper().startswith(s.prefix))
                for s in SURVEYS.values()
            ):
                outcome.append((name, None, NO_SURVEY))
            continue
        year = int(match.group(1))
        if wanted is not None and year not in wanted:
            continue
        df = open_table()
        if not set(survey.columns) <= {c.upper() for c in df.columns}:
            outcome.append((name, year, MISSING_COLUMNS))
            continue
        outcome.append((name, year, READ))
        read_years.add(year)
        frames.append(typed_rows(df, survey, {"table_name": name, "report_year": year}))
    rows = frames[0] if frames else _empty_rows(spark, survey)
    for df in frames[1:]:
        rows = rows.unionByName(df)
    return SurveyScan(rows, outcome, sorted(read_years))


def scan_report(spark: SparkSession, scan: SurveyScan) -> DataFrame:
    """What became of each table, one row per yearly table."""
    return spark.createDataFrame(scan.tables, "table_name string, report_year int, outcome string")


