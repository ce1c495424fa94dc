"""Line dedup: lines that several documents hold stay in the first of them only.

Each line's key (stripped, A-Z lowered) is hashed to 128 bits and exploded with its position. Distinct documents
are counted per hash, repeats inside a document falling together before any shuffle. Lines over the threshold meet
the first document that holds them; all others are dropped, and the rest of the text is put together by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.llm.shared import SPACES, free_names, let, stored
from edmart.operators.joins import lookup_join

MIN_DOCS = 2
MIN_CHARS = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row, pos, h1, h2) of every line whose key has ``min_chars`` code points; ``row`` is a hash of the text."""
    keys = F.transform(
        F.transform(lines_of(F.col("text")), line_key),
        lambda key, i: F.when(
            F.length(key) >= min_chars,
            F.struct(i.alias("pos"), F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")),
        ),
    )
    long = F.filter(keys, lambda k: k.isNotNull())
    each = docs.select("doc_id", F.xxhash64("text").alias("row"), F.explode(long).alias("k"))
    return each.select("doc_id", "row", "k.*")


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first_id) of the hashes that ``min_docs`` different documents hold.

    The rows without an id count as one document, which comes after all others.
    """
    documents = lines.select("h1", "h2", "doc_id").distinct()
    counts = documents.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    return counts.filter(F.col("n") >= min_docs).select("h1", "h2", "first_id")


def dropped_positions(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(doc_id, row, lost): the sorted positions of the dropped lines of the texts that lose any."""
    lines = stored(keyed_lines(docs, min_chars), "line-keys")
    # a line that many documents hold is a hot key: its rows can be split
    met = lookup_join(lines, shared_lines(lines, min_docs), ["h1", "h2"])
    lost = met.filter(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    # equal rows bring their positions twice
    return lost.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("pos")).alias("lost"))


def kept_lines(lines: Column, lost: Column) -> Column:
    """The lines between the lost positions, run by run: work and memory grow with the text alone."""

    def runs(edges: Column) -> Column:
        def run(edge: Column, i: Column) -> Column:
            start = F.coalesce(F.get(edges, i - 1), F.lit(-1)) + 1
            return F.slice(lines, start + 1, edge - start)

        return F.flatten(F.transform(edges, run))

    return let(F.concat(lost, F.array(F.size(lines))), runs)


def _rest(docs: DataFrame, min_docs: int, min_chars: int) -> tuple[DataFrame, str, str]:
    """``docs`` with a column of the lost positions (NULL for none) and one of the text that is left."""
    row, lost, left, key_id, key_row = free_names(docs, "_row", "_lost", "_left", "_key_id", "_key_row")
    gone = dropped_positions(docs.select("doc_id", "text"), min_docs, min_chars)
    gone = gone.select(F.col("doc_id").alias(key_id), F.col("row").alias(key_row), F.col("lost").alias(lost))
    rows = docs.withColumn(row, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(key_id)) & (F.col(row) == F.col(key_row))
    rows = rows.join(gone, same, "left").drop(row, key_id, key_row)
    rest = let(lines_of(F.col("text")), lambda lines: F.array_join(kept_lines(lines, F.col(lost)), "\n"))
    return rows.withColumn(left, F.when(F.col(lost).isNull(), F.col("text")).otherwise(rest)), lost, left


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and ``n_chars`` (if there) counted anew.

    A line goes if ``min_docs`` documents hold its key and its own document is not the one of the smallest id.
    Repeats of a line inside one document stay or go together. A text may end up empty; no row is dropped. NULL and
    empty texts, and texts that lose nothing, stay as they are. Rows of one id are one document; rows without an
    id are one document together, the last. Other columns pass through untouched.
    """
    rows, lost, left = _rest(docs, min_docs, min_chars)
    touched = F.col(lost).isNotNull()
    values = {"text": F.col(left)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(touched, F.length(left).cast(kind)).otherwise(F.col("n_chars"))
    return rows.withColumns(values).select(*docs.columns)


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row of ``docs`` (doc_id, text), as ``drop_repeated_lines``."""
    rows, lost, left = _rest(docs.select("doc_id", "text"), min_docs, min_chars)
    return rows.select(
        "doc_id",
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size(lost), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(F.col(left), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
