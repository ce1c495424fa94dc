"""Storing an intermediate result that is used more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Nodes of a logical plan that are worth storing instead of running again.
COSTLY = ("Join", "Aggregate", "Union", "Window", "Generate", "Sort", "Repartition")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors share (``spark.checkpoint.dir``).

    A local session without that setting gets a temporary folder; a cluster gets None.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="edmart-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/") if folder else None


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` computed once and kept in the shared folder: a checkpoint, or else a Parquet table read again.

    Runs a job now. The copy survives the loss of executors. A session whose context has a checkpoint
    folder gets a checkpoint. On a cluster that names no folder, ``df`` comes back as it is and is
    recomputed at each use.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is not None:
        return df.checkpoint(eager=True)
    folder = shared_folder(df.sparkSession)
    if folder is None:
        return df
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_computed(df: DataFrame) -> bool:
    """Whether the plan does more than read, select and filter rows."""
    names = set()

    def visit(node) -> None:
        names.add(node.nodeName())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().optimizedPlan())
    return any(word in name for name in names for word in COSTLY)


def cut_if_computed(df: DataFrame, name: str = "cut") -> DataFrame:
    """``cut`` for rows that come out of joins or groupings; stored rows are read where they lie."""
    return cut(df, name) if is_computed(df) else df
