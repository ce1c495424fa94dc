"""Distinct school names, their links to sources, and the stamps on universities."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edmart.operators.joins import lookup_join
from edmart.operators.lineage import cut_if_computed
from edmart.operators.match import UniversityIndex, better, choices


def name_id(name: str = "distinct_name"):
    """Id of a distinct name: the same in every run and every micro-batch."""
    return F.sha2(F.col(name), 256)


def new_distinct_names(sources: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct rows for the cleaned names of ``sources`` that ``known`` lacks."""
    names = sources.select(F.col("cleaned_name").alias("distinct_name")).filter("distinct_name IS NOT NULL").distinct()
    if known is not None:
        names = names.join(known.select("distinct_name"), "distinct_name", "left_anti")
    return names.select(
        name_id().alias("distinct_id"),
        "distinct_name",
        F.lit(None).cast("string").alias("distinct_scraper_status"),
        F.lit(None).cast("int").alias("distinct_ipeds_unitid"),
    )


def register_distinct(sources: DataFrame) -> DataFrame:
    """Initial registration: one distinct row per cleaned name."""
    return new_distinct_names(sources)


def source_links(sources: DataFrame, distinct_sources: DataFrame) -> DataFrame:
    """source_id -> distinct id, for sources whose name is registered."""
    ids = distinct_sources.select("distinct_id", F.col("distinct_name").alias("cleaned_name"))
    return lookup_join(sources.select("source_id", "cleaned_name"), ids, "cleaned_name").select(
        "source_id", F.col("distinct_id").alias("source_distinct_id")
    )


def link_sources(sources: DataFrame, distinct_sources: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Sources with ``source_distinct_id`` set where their name is registered.

    ``only`` (column source_id) limits the update to those sources.
    """
    links = distinct_sources.select(
        F.col("distinct_name").alias("cleaned_name"), F.col("distinct_id").alias("_new_id")
    )
    joined = lookup_join(sources, links, "cleaned_name", "left", ["source_id"])
    found = F.col("_new_id").isNotNull()
    if only is not None:
        marked = only.select("source_id").distinct().withColumn("_only", F.lit(True))
        joined = joined.join(marked, "source_id", "left")
        found = found & F.col("_only").isNotNull()
    old = F.col("source_distinct_id") if "source_distinct_id" in sources.columns else F.lit(None).cast("string")
    out = joined.withColumn("source_distinct_id", F.when(found, F.col("_new_id")).otherwise(old))
    return out.select(*dict.fromkeys([*sources.columns, "source_distinct_id"]))


def university_stamps(
    sources: DataFrame, linked: DataFrame, universities: DataFrame, index: UniversityIndex | None = None
) -> DataFrame:
    """unitid -> distinct id of one of ``sources`` matched to it; ``linked`` has their links.

    Several schools may match one university: the first by name gives the id.
    Unmatched sources stamp nothing. With a stored ``index`` only ``sources`` and the index are matched.
    """
    best = choices(sources, index or UniversityIndex.build(universities))
    matched = best.select("best.source_id", "best.unitid").filter("unitid IS NOT NULL")
    first = F.min(F.struct("cleaned_name", "source_distinct_id"))
    return (
        matched.join(linked.select("source_id", "cleaned_name", "source_distinct_id"), "source_id")
        .groupBy("unitid")
        .agg(first.alias("first"))
        .select("unitid", F.col("first.source_distinct_id").alias("_stamp"))
    )


def stamp_universities(universities: DataFrame, stamps: DataFrame) -> DataFrame:
    old = (
        F.col("university_distinct_id") if "university_distinct_id" in universities.columns
        else F.lit(None).cast("string")
    )
    hit = stamps.withColumn("_hit", F.lit(True))
    return (
        universities.join(hit, "unitid", "left")
        .withColumn("university_distinct_id", F.when(F.col("_hit"), F.col("_stamp")).otherwise(old))
        .drop("_hit", "_stamp")
    )


def back_fill_universities(sources: DataFrame, universities: DataFrame) -> DataFrame:
    """Universities stamped from all linked sources."""
    return stamp_universities(universities, university_stamps(sources, sources, universities))


class Linked(NamedTuple):
    distinct_sources: DataFrame
    sources: DataFrame
    universities: DataFrame


def on_new_sources(
    new: DataFrame,
    sources: DataFrame,
    distinct_sources: DataFrame,
    universities: DataFrame,
    index: UniversityIndex | None = None,
) -> Linked:
    """What follows an insert of ``new`` into ``sources`` (which already holds them).

    (1) register unseen names, (2) link the new sources, (3) match them and stamp
    their universities. Running it again with the same input changes nothing. Matching reads only ``new`` and the
    ``index`` of the universities, where one is stored.
    """
    new = cut_if_computed(new, "new-sources")
    names = distinct_sources.unionByName(
        new_distinct_names(new, distinct_sources), allowMissingColumns=True
    )
    linked = link_sources(sources, names, only=new)
    return Linked(names, linked, stamp_universities(universities, university_stamps(new, linked, universities, index)))


def on_new_universities(matched: DataFrame, sources: DataFrame, new: DataFrame) -> DataFrame:
    """``matched`` (the ``choices`` of all sources so far) after universities were added.

    The sources meet the new universities only. The best of the old and the new candidates is the best of
    all, so the result is that of matching everything again.
    """
    return better(matched, choices(sources, UniversityIndex.build(new)))
