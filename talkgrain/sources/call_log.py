"""The call log: typed rows, windows over it, and which slices of a window are complete."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.functions import text, timing


def read_call_log(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    return typed_call_log(spark.read.schema(schemas.CALL_LOG).format(file_format).load(path))


def typed_call_log(rows: DataFrame) -> DataFrame:
    """Text fields trimmed, never NULL; whole-number fields 0 when they cannot be read."""
    clean = {c: F.coalesce(text.strip(F.col(c)), F.lit("")) for c in K.CALL_LOG_TEXT_FIELDS}
    clean |= {c: F.coalesce(F.expr(f"try_cast({c} AS INT)"), F.lit(0)).cast("bigint") for c in K.CALL_LOG_INT_FIELDS}
    return rows.withColumns(clean)


def in_window(log: DataFrame, start: dt.datetime | Column, end: dt.datetime | Column, on: str = "start_ts") -> DataFrame:
    """Rows of the half-open period; a plain range that prunes partitions and row groups."""
    return log.where((F.col(on) >= F.lit(start)) & (F.col(on) < F.lit(end)))


def slice_report(log: DataFrame, start: dt.datetime, end: dt.datetime, failures: DataFrame | None = None,
                 minutes: int = K.SLICE_MINUTES, on: str = "start_ts") -> DataFrame:
    """Rows fetched per slice of a window, with the slices that returned nothing.

    An empty slice is a complete answer.  ``failures(slice_start, reason)`` names the slices whose
    fetch failed; they are listed with ``complete`` false and do not stop the others.
    """
    window = log.sparkSession.range(1).select(F.lit(start).cast("timestamp").alias("window_start"),
                                              F.lit(end).cast("timestamp").alias("window_end"))
    cut = timing.slices(window, minutes=minutes).select("slice_start", "slice_end")
    width = minutes * 60_000_000
    origin = F.unix_micros(F.lit(start).cast("timestamp"))
    number = F.floor((F.unix_micros(on) - origin) / width)
    counts = (in_window(log, start, end, on).groupBy(number.alias("_k")).agg(F.count("*").alias("row_count"))
              .select(F.timestamp_micros(origin + F.col("_k") * width).alias("slice_start"), "row_count"))
    report = (cut.join(counts, "slice_start", "left")
              .withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))))
    if failures is None:
        return report.withColumns({"reason": F.lit(None).cast("string"), "complete": F.lit(True)})
    return (report.join(failures.select("slice_start", "reason"), "slice_start", "left")
            .withColumn("complete", F.col("reason").isNull()))


def suspicious_slices(log: DataFrame, minutes: int = K.SLICE_MINUTES,
                      rows: int = K.SLICE_SUSPICIOUS_ROWS, on: str = "start_ts") -> DataFrame:
    """Slices so full that the source may have cut its answer short."""
    return (log.groupBy(F.window(on, f"{minutes} minutes").alias("w"))
            .agg(F.count("*").alias("row_count")).where(F.col("row_count") >= rows)
            .select(F.col("w.start").alias("slice_start"), F.col("w.end").alias("slice_end"), "row_count"))
