"""The training-data pipeline: quality rules, near and exact duplicates, benchmark leaks, tokens."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edmart.llm import decontaminate, quality_rules, sentencepieces, simhash, suffix_dedup
from edmart.llm.shared import shared_folder, table


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of 3-word shingles link at 2 or fewer bits."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, strings of 200 bytes that occur elsewhere taken out."""
    return suffix_dedup.remove_repeats(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the best segmentation of each document, and the scores of the best four."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.encode_docs(docs, path, with_ids=True)


STAGES = [
    ("quality rules", good_texts),
    ("near-dedup", one_per_group),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_leaks),
    ("sentencepiece encoding", encoded),
]

# n-gram weights, fingerprints, suffix sorting and lattice search have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    home = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{k}")
        docs = spark.read.parquet(f"{home}/{k}")
    return docs
