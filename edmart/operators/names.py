"""Containment of names by an index of letter runs (q-grams).

A name contains another only if it contains each of the other's q-grams, so one of them is enough to find the
pair: the rarest, which the fewest names share. The containing side emits its runs of ``Q`` letters, a number that
is linear in its length, and meets each contained name by that one key; ``contains`` then decides. Names
shorter than ``Q`` are their own key. Rows carry ids of names; texts are joined to the pairs found.

How rare a run is, is counted in ``BUCKETS`` buckets of its hash: one array of fixed size, so each name finds its
key by itself. Runs that share a bucket only look less rare than they are.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edmart.operators.joins import lookup_join
from edmart.operators.lineage import cut, cut_if_computed

Q = 4
BUCKETS = 1 << 12
KEY = ["width", "gram"]


def runs(text: Column, width: Column) -> Column:
    """Distinct (width, gram) of the runs of ``width`` letters, as hashes; none for a shorter text."""
    starts = F.sequence(F.lit(1), F.length(text) - width + 1)
    found = F.transform(
        starts, lambda i: F.struct(width.alias("width"), F.xxhash64(F.substring(text, i, width)).alias("gram"))
    )
    return F.when(F.length(text) >= width, F.array_distinct(found)).otherwise(F.array().cast("array<struct<width:int,gram:bigint>>"))


def identified(names: DataFrame) -> DataFrame:
    """(name_id, name) of different names, without NULL."""
    return names.filter("name IS NOT NULL").select(F.xxhash64("name").alias("name_id"), "name")


def distinct_names(names: DataFrame, column: str) -> DataFrame:
    """(name_id, name): the different texts of a column, without NULL; stored, as they are read several times."""
    return cut_if_computed(identified(names.select(F.col(column).alias("name")).distinct()), "names")


def emitted(names: DataFrame, widths: Column) -> DataFrame:
    """(name_id, width, gram) of the runs of each name, of the given widths."""
    each = names.select("name_id", "name", F.explode(widths).alias("width"))
    each = each.select("name_id", F.explode(runs(F.col("name"), F.col("width"))).alias("run"))
    return each.select("name_id", "run.*")


def bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def frequencies(grams: DataFrame) -> DataFrame:
    """One row, one array: how many of ``grams`` lie in each bucket."""
    counts = grams.groupBy(bucket(F.col("gram")).alias("id")).agg(F.count("*").alias("n"))
    full = grams.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("id")).join(counts, "id", "left")
    cells = F.array_sort(F.collect_list(F.struct("id", F.coalesce("n", F.lit(0)).alias("n"))))
    return full.agg(F.transform(cells, lambda c: c["n"]).alias("frequency"))


def keyed(names: DataFrame, frequency: DataFrame) -> DataFrame:
    """(name, width, gram): the rarest key of each name.

    A name with a run that no counted name has is contained in none of them and drops out.
    """
    own = runs(F.col("name"), F.least(F.length("name"), F.lit(Q)))
    rows = names.select("name", own.alias("own"), frequency.scalar().alias("frequency"))
    ranked = F.transform(
        "own", lambda r: F.struct(F.get(F.col("frequency"), bucket(r["gram"])).alias("n"), r["width"].alias("width"), r["gram"].alias("gram"))
    )
    return rows.select("name", F.array_min(ranked).alias("key")).filter("key.n > 0").select("name", "key.width", "key.gram")


class NameIndex(NamedTuple):
    """Names with all their runs of up to ``Q`` letters and their own rarest keys."""

    names: DataFrame
    grams: DataFrame
    keys: DataFrame
    frequency: DataFrame

    @classmethod
    def build(cls, names: DataFrame) -> NameIndex:
        """The index of (name_id, name); runs are emitted where they are used, until ``save`` stores them."""
        grams = emitted(names, F.array(*[F.lit(w) for w in range(Q + 1)]))
        frequency = cut(frequencies(grams), "name-frequency")
        return cls(names, grams, keyed(names, frequency), frequency)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NameIndex:
        names, grams, keys = (spark.read.parquet(f"{path}/{part}") for part in cls._fields[:3])
        return cls(names, grams, keys, cut(frequencies(grams), "name-frequency"))

    def save(self, path: str, mode: str = "errorifexists") -> None:
        for part in self._fields[:3]:
            getattr(self, part).write.mode(mode).parquet(f"{path}/{part}")

    def add(self, names: DataFrame, path: str) -> None:
        """Append the names (name_id, name) that the index stored at ``path`` lacks; of it only the ids are read."""
        new = cut(names.join(self.names.select("name_id"), "name_id", "left_anti"), "new-names")
        NameIndex.build(new).save(path, "append")

    def pairs(self, new: DataFrame) -> DataFrame:
        """(name, other): the names of ``new`` (name_id, name) with the indexed names that contain them or are contained.

        Only ``new`` and the index are read. A pair of equal names comes twice.
        """
        others = self.names.select(F.col("name_id").alias("other_id"), F.col("name").alias("other"))
        inside = (
            keyed(new, self.frequency)
            .transform(lookup_join, self.grams.withColumnRenamed("name_id", "other_id"), KEY)
            .transform(lookup_join, others, "other_id")
            .filter(F.contains("other", "name"))
        )
        # the widths that occur among the keys: at most Q + 1 numbers
        widths = self.names.agg(F.sort_array(F.collect_set(F.least(F.length("name"), F.lit(Q))))).scalar()
        around = (
            emitted(new, F.coalesce(widths, F.array().cast("array<int>")))
            .transform(lookup_join, self.keys.withColumnRenamed("name", "other"), KEY)
            .transform(lookup_join, new, "name_id")
            .filter(F.contains("name", "other"))
        )
        return inside.select("name", "other").unionByName(around.select("name", "other"))
