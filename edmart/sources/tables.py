"""Stored tables in and out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from edmart import schemas

# The tables the staging layer reads.
SOURCE_TABLES = (
    "sources", "urls", "scraper_schemas", "courses", "runs", "log_stages", "logs",
    "universities", "taxonomy01", "course_taxonomy01",
)

# The stages a log row can belong to.
LOG_STAGES = ((0, "crawl"), (1, "schema"), (2, "scrape"), (3, "storage"), (4, "classify"))


class Tables(Mapping[str, DataFrame]):
    """Named DataFrames; ``tables.logs`` and ``tables["logs"]`` are the same."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    @classmethod
    def load(
        cls, spark: SparkSession, directory: str, names: Iterable[str] = SOURCE_TABLES,
        format: str = "parquet", views: bool = False, suffix: str = "",
    ) -> Tables:
        """One table per file or sub-directory ``<name><suffix>`` of ``directory``.

        Declared tables get their declared columns and types, and keep what they have besides; a stored type that cannot
        become the declared one fails here, not in some later query.
        """
        frames = {}
        for name in names:
            path = f"{directory.rstrip('/')}/{name}{suffix}"
            df = spark.read.format(format).load(path)
            if name in schemas.TABLES:
                df = fitted(df, schemas.TABLES[name])
            frames[name] = df
            if views:
                frames[name].createOrReplaceTempView(name)
        return cls(frames)

    def with_tables(self, **frames: DataFrame) -> Tables:
        return Tables({**self._frames, **frames})

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["_frames"][name]
        except KeyError as e:
            raise AttributeError(name) from e

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)


def fitted(df: DataFrame, table: schemas.Table) -> DataFrame:
    """``df`` with the declared columns and types first; fails on a type that would lose values."""
    faults = schemas.type_faults(df, table)
    if faults:
        raise ValueError(f"{table.name}: {'; '.join(faults)}")
    return schemas.conform(df, table, keep_extra=True)


def load_versions(
    spark: SparkSession, path: str, table: schemas.Table, steps: Mapping[int, schemas.Step], newest: int
) -> DataFrame:
    """All rows of a table whose versions lie in folders ``version=<number>`` of ``path``, as the newest version.

    ``steps[n]`` leads from version n to n + 1. Old files are never rewritten: each folder is read with its own
    columns, goes through the steps that are missing, and is fitted to the declaration. A version without a folder
    has no rows.
    """
    out = spark.createDataFrame([], table.struct)
    for version in range(1, newest + 1):
        try:
            df = spark.read.parquet(f"{path.rstrip('/')}/version={version}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        for n in range(version, newest):
            if n in steps:
                df = steps[n].apply(df)
        out = out.unionByName(fitted(df, table).select(*table.struct.names))
    return out


def load_seed(
    spark: SparkSession, name: str, path: str | None = None, into: DataFrame | None = None
) -> DataFrame:
    """Seed rows of ``name``, added to ``into`` where their key is absent.

    The log stages are built in; other seeds (the taxonomy) are read from a CSV
    file with a header, given by ``path``.
    """
    table = schemas.TABLES[name]
    if path is not None:
        text = spark.read.csv(path, header=True, escape='"')
        seed = schemas.conform(text, table)
    elif name == "log_stages":
        seed = spark.createDataFrame(LOG_STAGES, table.struct)
    else:
        raise ValueError(f"no built-in seed for {name!r}: give a path")
    if into is None:
        return seed
    new = seed.join(into.select(*table.primary_key), list(table.primary_key), "left_anti")
    return into.unionByName(new, allowMissingColumns=True)


def save_mart(df: DataFrame, name: str, path: str | None = None, format: str = "parquet") -> DataFrame:
    """Publish a mart: a temp view, and with ``path`` also a stored copy (which the view then reads)."""
    if path is not None:
        df.write.mode("overwrite").format(format).save(path)
        df = df.sparkSession.read.format(format).load(path)
    df.createOrReplaceTempView(name)
    return df


def by_partition(df: DataFrame, table: schemas.Table) -> DataFrame:
    """Rows gathered by the table's partition columns and sorted by its key, for writing.

    The rebalance keeps files few (a task does not write into every year) and near
    the advisory size: adaptive execution splits a year that holds most rows and
    merges small ones. The sort makes row-group statistics on the key useful.
    """
    if not table.partition_by:
        return df
    return df.hint("rebalance", *table.partition_by).sortWithinPartitions(*table.partition_by, *table.merge_key)


def save_table(df: DataFrame, path: str, table: str, format: str = "parquet") -> None:
    """Write a new version of a table, facts partitioned by year."""
    declared = schemas.TABLES[table]
    out = by_partition(df, declared).write.mode("overwrite").format(format)
    if declared.partition_by:
        out = out.partitionBy(*declared.partition_by)
    out.save(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000, mode: str = "append",
) -> None:
    """Distributed bulk write to a database table, ``batch_size`` rows per round trip."""
    options = {**(properties or {}), "batchsize": str(batch_size)}
    df.write.jdbc(url, table, mode=mode, properties=options)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path``, one sorted file per bucket of ``key``, and read it back.

    Two tables with the same buckets join on ``key`` without a shuffle, and a bucketed table joins another one
    by moving only the other. ``key`` should be one that no row group dominates, such as a primary key. Choose
    ``buckets`` for files of about 128 MB to 1 GB, but not below ``spark.sql.shuffle.partitions`` of the sessions that
    join: Spark shuffles a side of fewer buckets after all. All tables that meet on ``key`` take the same number. The
    table is registered in the session's catalog, which is what tells later reads of its buckets; an existing table is replaced.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
