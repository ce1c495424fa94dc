"""Declared tables: columns, types, lengths, defaults, keys; and fitting a DataFrame to them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "decimal(10,4)": T.DecimalType(10, 4),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Col:
    """One declared column. ``length`` is a check, never a cut."""

    name: str
    type: str
    required: bool = False
    length: int | None = None
    default: object = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    # column -> (parent table, parent column, rows go with the parent)
    foreign_keys: Mapping[str, tuple[str, str, bool]] = field(default_factory=dict)
    merge_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, TYPES[c.type], not c.required) for c in self.columns]
        )


def _text(name: str, length: int | None = None, required: bool = False) -> Col:
    return Col(name, "string", required, length)


# The declared tables, names and lengths of the data model.
SOURCES = Table(
    "sources",
    (
        _text("source_id", required=True),
        _text("source_name", 50, True),
        _text("source_type", 15, True),
        Col("is_enabled", "boolean", True, default=True),
        _text("source_base_url", 200),
        _text("source_schema_url", 200),
        Col("include_external", "boolean"),
        Col("source_crawl_depth", "int"),
        Col("page_timeout_s", "int"),
        Col("max_concurrency", "int"),
        _text("url_base_exclude", 200),
        _text("url_exclude_patterns", 200),
        _text("src_host"),
        _text("cleaned_name"),
        _text("source_distinct_id"),
        _text("site_name", 500),
    ),
    primary_key=("source_id",),
    unique=(("source_name", "source_type"),),
    foreign_keys={"source_distinct_id": ("distinct_sources", "distinct_id", False)},
    merge_key=("source_name",),
)
URLS = Table(
    "urls",
    (
        _text("url_id", required=True),
        _text("url_source_id", required=True),
        _text("url_link", 300, True),
        Col("is_target", "boolean", default=True),
    ),
    primary_key=("url_id",),
    unique=(("url_source_id", "url_link"),),
    foreign_keys={"url_source_id": ("sources", "source_id", False)},
)
SCRAPER_SCHEMAS = Table(
    "scraper_schemas",
    (
        _text("scraper_schema_id", required=True),
        _text("scraper_schema_source_id", required=True),
        _text("scraper_schema_json", required=True),
    ),
    primary_key=("scraper_schema_id",),
    foreign_keys={"scraper_schema_source_id": ("sources", "source_id", False)},
    merge_key=("scraper_schema_source_id",),
)
COURSES = Table(
    "courses",
    (
        _text("course_id", required=True),
        _text("course_source_id", required=True),
        _text("course_title"),
        _text("course_description"),
        _text("course_code"),
        _text("course_credits"),
    ),
    primary_key=("course_id",),
    foreign_keys={"course_source_id": ("sources", "source_id", False)},
    merge_key=("course_source_id", "course_code", "course_title"),
)
RUNS = Table(
    "runs",
    (
        Col("run_id", "int", True),
        _text("run_status", 20, True),
        Col("run_start_time", "timestamp", True),
        Col("run_end_time", "timestamp"),
    ),
    primary_key=("run_id",),
)
LOG_STAGES = Table(
    "log_stages",
    (Col("stage_id", "smallint", True), _text("stage_name", 40, True)),
    primary_key=("stage_id",),
)
LOGS = Table(
    "logs",
    (
        Col("log_id", "int", True),
        Col("log_run_id", "int", True),
        _text("log_source_id"),
        Col("log_stage", "smallint", True),
        _text("log_message"),
        Col("log_ts", "timestamp", True),
        _text("log_level", 10),
        _text("event_type", 50),
        _text("details"),
        _text("metric_name", 50),
        Col("metric_value", "double"),
    ),
    primary_key=("log_id",),
    foreign_keys={
        "log_run_id": ("runs", "run_id", False),
        "log_source_id": ("sources", "source_id", True),
        "log_stage": ("log_stages", "stage_id", False),
    },
)
UNIVERSITIES = Table(
    "universities",
    (
        Col("unitid", "int", True),
        _text("instnm", 255, True),
        _text("addr", 255),
        _text("city", 100),
        _text("stabbr", 2, True),
        _text("zip", 10),
        _text("webaddr", 255),
        Col("control", "smallint"),
        Col("sector", "smallint"),
        Col("c18basic", "smallint"),
        Col("hbcu", "boolean"),
        Col("c21szset", "smallint"),
        _text("uni_host"),
        _text("university_distinct_id"),
    ),
    primary_key=("unitid",),
    foreign_keys={"university_distinct_id": ("distinct_sources", "distinct_id", False)},
    merge_key=("unitid",),
)
PROGRAMS = Table(
    "programs",
    (
        Col("cipcode", "decimal(10,4)", True),
        _text("program_name", 255, True),
        _text("program_description"),
    ),
    primary_key=("cipcode",),
    merge_key=("cipcode",),
)
ENROLLMENT = Table(
    "enrollment_fact",
    (
        Col("enrollment_id", "bigint", True),
        Col("report_year", "int", True),
        Col("unitid", "int", True),
        Col("student_level", "smallint", True),
        Col("total_headcount", "int"),
    ),
    primary_key=("enrollment_id",),
    foreign_keys={"unitid": ("universities", "unitid", False)},
    merge_key=("unitid", "report_year", "student_level"),
    partition_by=("report_year",),
)
COMPLETIONS = Table(
    "completions_fact",
    (
        Col("completion_id", "bigint", True),
        Col("report_year", "int", True),
        Col("unitid", "int", True),
        Col("cipcode", "decimal(10,4)", True),
        Col("award_level", "int", True),
        Col("total_completions", "int"),
    ),
    primary_key=("completion_id",),
    foreign_keys={
        "unitid": ("universities", "unitid", False),
        "cipcode": ("programs", "cipcode", False),
    },
    merge_key=("unitid", "report_year", "cipcode", "award_level"),
    partition_by=("report_year",),
)
GRADRATES = Table(
    "graduationrates_fact",
    (
        Col("graduationrate_id", "bigint", True),
        Col("report_year", "int", True),
        Col("unitid", "int", True),
        Col("grtype", "smallint", True),
        Col("grtotlt", "int"),
    ),
    primary_key=("graduationrate_id",),
    foreign_keys={"unitid": ("universities", "unitid", False)},
    merge_key=("unitid", "report_year", "grtype"),
    partition_by=("report_year",),
)
TAXONOMY = Table(
    "taxonomy01",
    (_text("taxonomy_id", 50, True), _text("taxonomy_description")),
    primary_key=("taxonomy_id",),
)
COURSE_TAXONOMY = Table(
    "course_taxonomy01",
    (
        _text("course_id", required=True),
        _text("taxonomy_id", 50, True),
        Col("hydrogen_related", "boolean", True, default=False),
        _text("classification_note", 400),
    ),
    primary_key=("course_id", "taxonomy_id"),
    foreign_keys={
        "course_id": ("courses", "course_id", True),
        "taxonomy_id": ("taxonomy01", "taxonomy_id", True),
    },
)
KEYWORDS = Table(
    "keywords01",
    (_text("keyword_id", 50, True), _text("keyword_description")),
    primary_key=("keyword_id",),
)
COURSE_KEYWORDS = Table(
    "course_keywords01",
    (_text("course_id", required=True), _text("keyword_id", 50, True)),
    primary_key=("course_id", "keyword_id"),
    foreign_keys={
        "course_id": ("courses", "course_id", True),
        "keyword_id": ("keywords01", "keyword_id", True),
    },
)
DISTINCT_SOURCES = Table(
    "distinct_sources",
    (
        _text("distinct_id", required=True),
        _text("distinct_name", 255, True),
        _text("distinct_scraper_status"),
        Col("distinct_ipeds_unitid", "int"),
    ),
    primary_key=("distinct_id",),
)
SEARCH_RESULTS = Table(
    "search_results",
    (
        _text("search_results_id", required=True),
        _text("search_results_distinct_id"),
        _text("url", 500, True),
        _text("info"),
        _text("search_query", 500),
    ),
    primary_key=("search_results_id",),
    unique=(("search_results_distinct_id", "url"),),
    foreign_keys={"search_results_distinct_id": ("distinct_sources", "distinct_id", False)},
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        SOURCES, URLS, SCRAPER_SCHEMAS, COURSES, RUNS, LOG_STAGES, LOGS, UNIVERSITIES, PROGRAMS,
        ENROLLMENT, COMPLETIONS, GRADRATES, TAXONOMY, COURSE_TAXONOMY, KEYWORDS, COURSE_KEYWORDS,
        DISTINCT_SOURCES, SEARCH_RESULTS,
    )
}

def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, TYPES[t]) for n, t in columns.items()])


# The batches accepted by the maintenance functions.
BATCHES: dict[str, T.StructType] = {
    "names": _struct(source_name="string", source_base_url="string"),
    "courses": _struct(
        course_code="string", course_title="string", course_description="string", course_credits="string"
    ),
    "labels": _struct(course_id="string", taxonomy_id="string"),
    "programs": _struct(cipcode="string", program_name="string", program_description="string"),
    "universities": _struct(**{c.name: c.type for c in UNIVERSITIES.columns[:12]}),
    "enrollment": _struct(report_year="int", unitid="int", student_level="smallint", total_headcount="int"),
    "completions": _struct(
        report_year="int", unitid="int", cipcode="string", award_level="int", total_completions="int"
    ),
    "gradrates": _struct(report_year="int", unitid="int", grtype="smallint", grtotlt="int"),
}


def _converted(df: DataFrame, name: str, target: T.DataType) -> Column:
    have = df.schema[name].dataType
    col = F.col(name)
    if have == target:
        return col
    # Text that does not read as the declared type becomes NULL and is left to check_columns.
    return col.try_cast(target) if isinstance(have, T.StringType) else col.cast(target)


def conform(
    df: DataFrame,
    schema: Table | T.StructType,
    renames: Mapping[str, str] | None = None,
    keep_extra: bool = False,
) -> DataFrame:
    """Fit ``df`` to a declared schema: rename, add, widen, drop, order and fill defaults.

    A column missing from ``df`` gets its default (NULL without one). A NULL in a
    column that is present stays NULL: defaults apply to absent input only.
    """
    defaults = {c.name: c.default for c in schema.columns} if isinstance(schema, Table) else {}
    struct = schema.struct if isinstance(schema, Table) else schema
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    out = []
    for f in struct.fields:
        if f.name in df.columns:
            out.append(_converted(df, f.name, f.dataType).alias(f.name))
        else:
            out.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    if keep_extra:
        out += [F.col(c) for c in df.columns if c not in struct.names]
    return df.select(*out)


# Numbers that hold every value of a smaller kind, smallest first.
_WIDER = ("tinyint", "smallint", "int", "bigint")


def type_faults(df: DataFrame, schema: Table | T.StructType) -> list[str]:
    """Columns whose stored type cannot become the declared one without losing values; texts are left to the row checks."""
    faults = []
    for f in (schema.struct if isinstance(schema, Table) else schema).fields:
        if f.name not in df.columns:
            continue
        have, want = df.schema[f.name].dataType.simpleString(), f.dataType.simpleString()
        whole = have in _WIDER
        wider = whole and want in _WIDER and _WIDER.index(have) <= _WIDER.index(want)
        # four decimals leave six digits before the point
        holds = want in ("double", "decimal(10,4)") and have in ("tinyint", "smallint")
        plain = have in ("string", "void") or want == "string" or (have == "float" and want == "double")
        days = have in ("date", "timestamp_ntz") and want == "timestamp"
        if not (have == want or wider or holds or plain or days or (have == "int" and want == "double")):
            faults.append(f"{f.name} is {have}, declared {want}")
    return faults


@dataclass(frozen=True)
class Step:
    """What a new version of a stored table changes: columns renamed, added with a value, dropped."""

    renames: Mapping[str, str] = field(default_factory=dict)
    adds: Mapping[str, object] = field(default_factory=dict)
    drops: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        df = df.withColumnsRenamed(dict(self.renames)).drop(*self.drops)
        return df.withColumns({c: F.lit(v) for c, v in self.adds.items() if c not in df.columns}) if self.adds else df


def require_batch(df: DataFrame, batch: str) -> DataFrame:
    """Check that a batch argument has the declared columns, and give them their types."""
    struct = BATCHES[batch]
    missing = [n for n in struct.names if n not in df.columns]
    if missing:
        raise ValueError(f"batch {batch!r} lacks columns {missing}")
    return conform(df, struct)
