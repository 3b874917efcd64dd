"""Tables between the rounds of an iterative job, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only on a local master where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ridgeline-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of its own: nothing above runs again, and columns are known to what reads it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ridgeline-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return shuffled(spark.read.schema(df.schema).parquet(path))


def shuffled(df: DataFrame) -> DataFrame:
    """df, which joins then shuffle and never send whole through the driver: Spark judges a table by its compressed bytes and
    counts no rows that an explode makes, so a side taken for small may not fit the driver's memory."""
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df over all of the session's shuffle partitions, by keys if any: Spark joins small ones, and a row of few bytes may have much work to come."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")), *keys)


def forget(df: DataFrame | None) -> None:
    """Removes a table that settled() wrote, once nothing reads it any more."""
    if df is None:
        return
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("ridgeline-"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
