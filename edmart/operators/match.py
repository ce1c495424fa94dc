"""Entity matching by web host and by name containment.

The theta joins (``a LIKE '%' || b || '%'``) are written as equi-joins: names meet through an index of their
rarest letter runs (``names``), hosts through the dot suffixes of the longer one. No pair is built because two
names merely share a common fragment. Names are deduplicated on both sides first, and only names that no host
has settled are matched at all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edmart.operators.joins import lookup_join
from edmart.operators.lineage import cut
from edmart.operators.names import KEY, NameIndex, Q, distinct_names, emitted, frequencies, identified, keyed


def contains_pairs(longs: DataFrame, long: str, shorts: DataFrame, short: str) -> DataFrame:
    """All pairs of rows where ``long`` contains ``short``; columns of both sides are kept.

    Both sides should be distinct on their text.
    """
    around, inside = distinct_names(longs, long), distinct_names(shorts, short)
    widths = F.array(*[F.lit(w) for w in range(Q + 1)])
    grams = emitted(around, widths)
    keys = keyed(inside, frequencies(grams)).withColumnRenamed("name", short)
    pairs = lookup_join(grams, keys, KEY).join(around.withColumnRenamed("name", long), "name_id")
    pairs = pairs.filter(F.contains(F.col(long), F.col(short))).select(long, short)
    return longs.join(pairs, long).join(shorts, short)


def _keep_unmatched(names: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Left join of distinct names with their pairs, as matched rows plus unmatched names.

    An outer join could not split a name that owns a third of the pairs; here the
    pairs are never joined again, only their distinct names are.
    """
    unmatched = names.join(pairs.select(key).distinct(), key, "left_anti")
    return pairs.unionByName(unmatched, allowMissingColumns=True)


def similar_sources(names: DataFrame, sources: DataFrame, courses: DataFrame, stage: bool = True) -> DataFrame:
    """Input names with the enabled, course-owning schools whose name contains them or is contained.

    The pairs are used twice; with ``stage`` they are stored in the shared folder first.
    """
    wanted = distinct_names(names, "source_name")
    owners = courses.select(F.col("course_source_id").alias("source_id")).distinct()
    schools = (
        sources.filter("is_enabled")
        .select("source_id", "cleaned_name")
        .join(owners, "source_id", "left_semi")
        .select("cleaned_name")
        .distinct()
    )
    pairs = NameIndex.build(distinct_names(schools, "cleaned_name")).pairs(wanted).distinct()
    pairs = pairs.select(F.col("name").alias("source_name"), F.col("other").alias("cleaned_name"))
    pairs = cut(pairs, "similar-pairs") if stage else pairs
    return _keep_unmatched(names.select("source_name").distinct(), pairs, "source_name")


def similar_universities(names: DataFrame, universities: DataFrame, stage: bool = True) -> DataFrame:
    """Input names with the hosts of institutions whose name contains them or is contained.

    ``stage`` as in ``similar_sources``.
    """
    wanted = distinct_names(names, "source_name")
    institutions = universities.select("instnm", "uni_host").distinct()
    found = NameIndex.build(distinct_names(institutions, "instnm")).pairs(wanted)
    pairs = (
        found.select(F.col("name").alias("source_name"), F.col("other").alias("instnm"))
        .distinct()
        .join(institutions, "instnm")
        .select("source_name", "uni_host")
        .distinct()
    )
    pairs = cut(pairs, "similar-pairs") if stage else pairs
    return _keep_unmatched(names.select("source_name").distinct(), pairs, "source_name")


def host_suffixes(host: Column) -> Column:
    """The host and what follows each of its dots."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


class UniversityIndex(NamedTuple):
    """What matching reads of the universities: the smallest unit per host and per lowered name, and the name index."""

    hosts: DataFrame
    units: DataFrame
    names: NameIndex

    @classmethod
    def build(cls, universities: DataFrame) -> UniversityIndex:
        known = universities.select("unitid", "uni_host", F.lower("instnm").alias("uni_key"))
        hosts = known.filter("uni_host IS NOT NULL").groupBy("uni_host").agg(F.min("unitid").alias("host_unitid"))
        units = known.filter("uni_key IS NOT NULL").groupBy("uni_key").agg(F.min("unitid").alias("name_unitid"))
        units = cut(units, "university-names")
        return cls(hosts, units, NameIndex.build(identified(units.select(F.col("uni_key").alias("name")))))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> UniversityIndex:
        hosts, units = (spark.read.parquet(f"{path}/{part}") for part in ("hosts", "units"))
        hosts = hosts.groupBy("uni_host").agg(F.min("host_unitid").alias("host_unitid"))
        units = units.groupBy("uni_key").agg(F.min("name_unitid").alias("name_unitid"))
        return cls(hosts, units, NameIndex.load(spark, f"{path}/names"))

    def save(self, path: str) -> None:
        self.hosts.write.parquet(f"{path}/hosts")
        self.units.write.parquet(f"{path}/units")
        self.names.save(f"{path}/names")

    def add(self, universities: DataFrame, path: str) -> None:
        """Append new universities to the index stored at ``path``."""
        new = UniversityIndex.build(universities)
        new.hosts.write.mode("append").parquet(f"{path}/hosts")
        new.units.write.mode("append").parquet(f"{path}/units")
        self.names.add(new.names.names, f"{path}/names")

    def by_host(self, sources: DataFrame) -> DataFrame:
        """src_host -> smallest unitid whose host equals it or is one of its dot suffixes."""
        hosts = sources.select("src_host").filter("src_host IS NOT NULL").distinct()
        return (
            hosts.withColumn("uni_host", F.explode(host_suffixes(F.col("src_host"))))
            .transform(lookup_join, self.hosts, "uni_host")
            .groupBy("src_host")
            .agg(F.min("host_unitid").alias("host_unitid"))
        )

    def by_name(self, keys: DataFrame, column: str) -> DataFrame:
        """Lowered name -> smallest unitid whose lowered name contains it or is contained."""
        new = identified(keys.select(F.col(column).alias("name")).distinct())
        pairs = self.names.pairs(new).select(F.col("name").alias(column), F.col("other").alias("uni_key"))
        found = lookup_join(pairs, self.units, "uni_key")
        return found.groupBy(column).agg(F.min("name_unitid").alias("name_unitid"))


def _choice() -> Column:
    """What decides between the candidates of a source name: the smallest of these is taken."""
    by_host = F.col("host_unitid").isNotNull()
    unitid = F.coalesce("host_unitid", "name_unitid")
    return F.struct(
        F.when(by_host, 1).otherwise(2).alias("match_rank"),
        unitid.isNull().alias("is_unmatched"),
        unitid.alias("unitid"),
        "source_id",
        "cleaned_name",
        "src_host",
        F.when(by_host, "host_match")
        .when(unitid.isNotNull(), "name_match")
        .otherwise("no_match")
        .alias("match_type"),
    )


def choices(sources: DataFrame, index: UniversityIndex) -> DataFrame:
    """(source_name, best): the best candidate of each source name, by host first, else by name, else none.

    Names are only matched where no source of the name is settled by its host.
    """
    rows = sources.select("source_id", "source_name", "cleaned_name", "src_host", F.lower("cleaned_name").alias("name_key"))
    hosted = lookup_join(rows, index.by_host(rows), "src_host")
    settled = hosted.select("source_name").distinct()
    # read for their names and for the join with what these found
    others = cut(lookup_join(rows, settled, "source_name", "left_anti", ["source_id"]), "without-host")
    named = lookup_join(others, index.by_name(others, "name_key"), "name_key", "left", ["source_id"])
    both = hosted.unionByName(named, allowMissingColumns=True)
    return both.groupBy("source_name").agg(F.min(_choice()).alias("best"))


def better(old: DataFrame, new: DataFrame) -> DataFrame:
    """The better of two sets of ``choices``, per source name: how matches stay right when universities arrive."""
    both = old.unionByName(new)
    return both.groupBy("source_name").agg(F.min("best").alias("best"))


def described(best: DataFrame, universities: DataFrame) -> DataFrame:
    """``choices`` with the university's name and host."""
    extra = [c for c in ("universities_table_id",) if c in universities.columns]
    institutions = universities.select("unitid", "instnm", "uni_host", *extra)
    flat = best.select("source_name", "best.*")
    return lookup_join(flat, institutions, "unitid", "left", ["source_name"]).select(
        "cleaned_name",
        "source_name",
        "source_id",
        "instnm",
        "src_host",
        "uni_host",
        "unitid",
        *extra,
        "match_type",
        F.lit(1).cast("bigint").alias("rn"),
    )


def match_sources(sources: DataFrame, universities: DataFrame, index: UniversityIndex | None = None) -> DataFrame:
    """One row per source name with its university: by host first, else by name, else none.

    Ties take the smallest unitid, then the smallest source id. Only the smallest
    unitid per host and per name is carried through the joins; names and hosts of
    the chosen universities come from one join at the end. With a stored ``index`` of the universities only
    the sources and the index are matched.
    """
    return described(choices(sources, index or UniversityIndex.build(universities)), universities)
