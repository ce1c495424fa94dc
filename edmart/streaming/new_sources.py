"""Newly registered sources as a stream of micro-batches.

Two queries read the stream. One finds the names that are seen for the first time: ``dropDuplicates`` keeps them in a
state store on disk (RocksDB), so a micro-batch costs what its own names cost, however many were seen before. The
other links and matches each micro-batch and appends, in partitions of its own. The folders:

``first_seen``         names, from the state store, written exactly once
``distinct_sources``   names of batches that were processed without the state store
``source_links``       source_id -> distinct id
``university_stamps``  unitid -> distinct id

Nothing stored earlier is rewritten or read. A batch that is run again after a failure
overwrites its own partitions only, so it leaves the same result. The functions at the end give the tables as of now.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edmart.operators.lineage import cut
from edmart.operators.match import UniversityIndex
from edmart.operators.normalise import normalise_sources
from edmart.plans import linking

FIRST_SEEN = ("first_seen", "distinct_id string, distinct_name string")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NAMES = ("distinct_sources", "distinct_id string, distinct_name string, batch_id bigint")
LINKS = ("source_links", "source_id string, source_distinct_id string, batch_id bigint")
STAMPS = ("university_stamps", "unitid int, _stamp string, batch_id bigint")


def _read(spark: SparkSession, base: str, table: tuple[str, str]) -> DataFrame:
    """All batches of one folder; empty before the first batch has been written."""
    name, schema = table
    try:
        return spark.read.schema(schema).parquet(f"{base}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _append(df: DataFrame, base: str, table: tuple[str, str], batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(f"{base}/{table[0]}")
    )


def first_seen(stream: DataFrame) -> DataFrame:
    """(distinct_id, distinct_name) of the names a stream of new sources brings for the first time."""
    names = normalise_sources(stream).select(F.col("cleaned_name").alias("distinct_name"))
    names = names.filter("distinct_name IS NOT NULL").dropDuplicates(["distinct_name"])
    return names.select(linking.name_id().alias("distinct_id"), "distinct_name")


def links(new: DataFrame, registered: DataFrame | None) -> DataFrame:
    """``new`` with ``source_distinct_id``: the id that is registered for its name, else the name's own."""
    own = F.when(F.col("cleaned_name").isNotNull(), linking.name_id("cleaned_name"))
    if registered is None:
        return new.withColumn("source_distinct_id", own)
    linked = linking.link_sources(new, registered.select("distinct_id", "distinct_name"))
    return linked.withColumn("source_distinct_id", F.coalesce("source_distinct_id", own))


def process_batch(
    new: DataFrame,
    batch_id: int,
    base: str,
    universities: DataFrame,
    registered: DataFrame | None = None,
    with_names: bool = True,
    index: UniversityIndex | None = None,
) -> None:
    """Links and stamps of one batch of new sources, and its new names unless a state store finds them.

    ``registered`` holds distinct names stored before the stream began. With an ``index`` of the universities, these
    are not read.
    """
    spark = new.sparkSession
    # read for names, links and matching
    new = cut(normalise_sources(new), "new-sources")
    if with_names:
        names = _read(spark, base, NAMES).filter(F.col("batch_id") < batch_id).select("distinct_id", "distinct_name")
        if registered is not None:
            names = names.unionByName(registered.select("distinct_id", "distinct_name"))
        fresh = linking.new_distinct_names(new, names).select("distinct_id", "distinct_name")
        _append(fresh, base, NAMES, batch_id)

    # Ids are hashes of the names, so the links do not depend on what was written before.
    linked = links(new, registered)
    found = linked.filter("source_distinct_id IS NOT NULL").select("source_id", "source_distinct_id")
    _append(found, base, LINKS, batch_id)
    _append(linking.university_stamps(linked, linked, universities, index), base, STAMPS, batch_id)


class Running(NamedTuple):
    """The two queries of one stream."""

    names: StreamingQuery
    links: StreamingQuery

    def awaitTermination(self, timeout: int | None = None) -> bool:
        return all([q.awaitTermination(timeout) is not False for q in self])

    def stop(self) -> None:
        for q in self:
            q.stop()


def start(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    universities: Callable[[], DataFrame],
    registered: DataFrame | None = None,
    available_now: bool = True,
    index: Callable[[], UniversityIndex] | None = None,
) -> Running:
    """Run both queries over a stream of new source rows.

    ``universities`` (and ``index``) is called per batch, so a refreshed table is picked up.
    """
    spark = stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        own = None if index is None else index()
        process_batch(batch, batch_id, base, universities(), registered, with_names=False, index=own)

    def begin(writer, name: str) -> StreamingQuery:
        writer = writer.option("checkpointLocation", f"{checkpoint}/{name}")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        names = first_seen(stream).writeStream.format("parquet").option("path", f"{base}/{FIRST_SEEN[0]}")
        return Running(begin(names, "names"), begin(stream.writeStream.foreachBatch(handle), "links"))
    finally:
        spark.conf.set(provider, before)


def distinct_sources(spark: SparkSession, base: str, registered: DataFrame | None = None) -> DataFrame:
    names = _read(spark, base, NAMES).select("distinct_id", "distinct_name").unionByName(_read(spark, base, FIRST_SEEN))
    names = names.distinct()
    if registered is None:
        return names
    names = names.join(registered.select("distinct_name"), "distinct_name", "left_anti")
    return registered.unionByName(names, allowMissingColumns=True)


def linked_sources(spark: SparkSession, base: str, sources: DataFrame) -> DataFrame:
    """Sources with the links written so far; the last batch that linked a source decides."""
    links = (
        _read(spark, base, LINKS).groupBy("source_id").agg(F.max_by("source_distinct_id", "batch_id").alias("_new"))
    )
    old = F.col("source_distinct_id") if "source_distinct_id" in sources.columns else F.lit(None).cast("string")
    return (
        sources.join(links, "source_id", "left")
        .withColumn("source_distinct_id", F.coalesce("_new", old))
        .drop("_new")
    )


def stamped_universities(spark: SparkSession, base: str, universities: DataFrame) -> DataFrame:
    """Universities with the stamps written so far; the last batch that matched one decides."""
    stamps = _read(spark, base, STAMPS).groupBy("unitid").agg(F.max_by("_stamp", "batch_id").alias("_stamp"))
    return linking.stamp_universities(universities, stamps)
