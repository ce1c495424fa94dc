"""Helpers the operators share: free column names and tables kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rule: the space and code points 9 to 13. Fixed value.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Each wanted name, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """The runs of characters other than the six white space characters; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the optimizer moves the expression.

    Lambdas that look at a whole array for each of its elements need this: an array
    given as an expression would be built anew for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a local one where that is unset, as in tests.

    On a cluster there is no such local folder: without the setting the job fails.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="edmart-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Cuts the lineage: later jobs read files that outlive any executor. The folder
    is new for each call, so a repeated run never meets older files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables; for those whose every reader has itself been stored."""
    for df in tables:
        files = df.inputFiles()
        if files:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(conf).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
