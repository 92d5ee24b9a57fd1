"""Helpers of the training-data operators: shared storage and the shape of their inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session without one gets a temporary folder; a cluster must name it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: lineage ends here, and a lost executor loses nothing.

    The table is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    forget_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def forget_at_exit(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def picked(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other columns of the input can't clash with them."""
    return df.select(*((df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()))


def whole(text: Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(text, F.lit(""))


def stretches(texts: Sequence[str], most: int = 1_000_000) -> Iterator[slice]:
    """Slices of a batch that hold about `most` characters, or one text that is longer: what a task works out for all texts of a
    slice at once stays small, whatever the batch."""
    first = size = 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > most:
            yield slice(first, k)
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield slice(first, len(texts))
