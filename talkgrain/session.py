"""Session settings the library assumes."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "talkgrain", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared folder for checkpoints: the one in use, else the one the cluster names.

    A local session that has neither gets a folder of its own; a cluster never does, as a folder of
    one machine would be lost to the others.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="spark-")
    if folder is not None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    return df.checkpoint()
