"""Structured Streaming forms of the batch rules.  Each uses the batch transform it mirrors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from talkgrain import constants as K
from talkgrain.sources import storage


def first_deliveries(log: DataFrame, on: str = "start_ts", key: str = "callid", delay: str = "1 hour") -> DataFrame:
    """The first row of each call id among those delivered within the delay of each other."""
    return log.where(F.col(key) != "").withWatermark(on, delay).dropDuplicatesWithinWatermark([key])


def suspicious_slices(log: DataFrame, on: str = "start_ts", minutes: int = K.SLICE_MINUTES,
                      rows: int = K.SLICE_SUSPICIOUS_ROWS, delay: str = "1 hour") -> DataFrame:
    counted = (log.withWatermark(on, delay).groupBy(F.window(on, f"{minutes} minutes").alias("w"))
               .agg(F.count("*").alias("row_count")))
    return counted.where(F.col("row_count") >= rows).select(
        F.col("w.start").alias("slice_start"), F.col("w.end").alias("slice_end"), "row_count")


def business_day_totals(calls: DataFrame, on: str = "started_at", offset: str = "20 hours 30 minutes",
                        delay: str = "6 hours") -> DataFrame:
    """Totals of each 02:00 tenant day; ``offset`` is that hour in UTC.

    The watermark is how long a day stays open for late rows; what comes later is picked up by the
    batch rebuild.
    """
    flags = F.coalesce("flag_count", F.lit(0))
    day = F.window(on, "1 day", "1 day", offset).alias("w")
    return (calls.withWatermark(on, delay).groupBy(day).agg(
        F.count("*").alias("total_calls"), F.count_if(F.col("processing_status") == "PROCESSED").alias("audited_calls"),
        F.count("score").alias("scored_calls"), F.sum(flags).alias("total_flags"),
        F.coalesce(F.sum("score"), F.lit(0.0)).alias("score_sum"), F.sum("duration_sec").alias("total_duration_sec"))
        .withColumn("business_day", F.date_format(F.from_utc_timestamp("w.start", K.TENANT_ZONE), "yyyy-MM-dd")).drop("w"))


STALL_OUTPUT = StructType([StructField("call_id", StringType()), StructField("since", TimestampType()),
                           StructField("failed_at", TimestampType())])


class _StallWatch(StatefulProcessor):
    """Remember when a call went INGESTING; report it when the timer finds it still there.

    Nothing is kept of a call that is done: once the watermark has passed its newest change, an older one would be too late to come in.
    """

    def __init__(self, minutes: int) -> None:
        self._wait_ms = minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._since = handle.getValueState("since", StructType([StructField("ms", LongType())]))
        self._seen = handle.getValueState("seen", StructType([StructField("ms", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("status_at")
        last = events.iloc[-1]
        changed = int(pd.Timestamp(last["status_at"]).timestamp() * 1000)
        if self._seen.exists() and self._seen.get()[0] > changed:
            return  # an older change that comes late
        self._seen.update((changed,))
        for due in list(self._handle.listTimers()):
            self._handle.deleteTimer(due)
        if last["processing_status"] == "INGESTING":
            self._since.update((changed,))
            self._handle.registerTimer(changed + self._wait_ms)
        else:
            self._since.clear()
            self._handle.registerTimer(changed + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._seen.clear()
        if self._since.exists():
            since = self._since.get()[0]
            self._since.clear()
            yield pd.DataFrame({
                "call_id": [key[0]], "since": [pd.Timestamp(since, unit="ms")],
                "failed_at": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")]})

    def close(self) -> None:
        pass


def stalled_ingests(changes: DataFrame, minutes: int = K.STUCK_AFTER_MINUTES, delay: str = "10 minutes") -> DataFrame:
    """Calls that stay INGESTING for ``minutes`` of event time.

    ``changes(call_id, processing_status, status_at)``, and ``started_at`` where a change may lack its own
    time, as in the batch rule.  State is two numbers per call: since when it is INGESTING, and the time of
    its newest change, against which older ones that come late are ignored.
    """
    if "started_at" in changes.columns:
        changes = changes.withColumn("status_at", F.coalesce("status_at", "started_at")).drop("started_at")
    return (changes.withWatermark("status_at", delay).groupBy("call_id")
            .transformWithStateInPandas(_StallWatch(minutes), STALL_OUTPUT, "Append", "EventTime"))


def stalled_by_session(changes: DataFrame, minutes: int = K.STUCK_AFTER_MINUTES, delay: str = "10 minutes") -> DataFrame:
    """``stalled_ingests`` without Python, for many calls: changes of a call less than ``minutes`` apart are one session.

    A session is given out once the watermark has passed its last change by ``minutes``; if that change is INGESTING, the call was stuck all
    the while.  What comes of it does not hang on how rows are dealt into batches.  At one time, a change that ends the ingest counts last.
    """
    if "started_at" in changes.columns:
        changes = changes.withColumn("status_at", F.coalesce("status_at", "started_at")).drop("started_at")
    ingesting = F.coalesce(F.col("processing_status") == "INGESTING", F.lit(False))
    newest = F.max(F.struct(F.col("status_at").alias("at"), (~ingesting).alias("done"))).alias("last")
    sessions = (changes.withWatermark("status_at", delay)
                .groupBy("call_id", F.session_window("status_at", f"{minutes} minutes").alias("w")).agg(newest))
    return sessions.where("not last.done").select("call_id", F.col("last.at").alias("since"), F.col("w.end").alias("failed_at"))


def insert_if_absent_batch(path: str, key: str = "call_id") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that writes only keys the table at ``path`` does not hold.

    A batch that is run again finds its own rows stored and adds nothing.
    """
    def write(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.schema(batch.schema).parquet(path)
        storage.insert_if_absent(batch, stored, path, key)

    return write


def rebuild_touched_days(build: Callable[[DataFrame], DataFrame], path: str,
                         started: str = "started_at") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: the days a batch touches are built again and replaced.

    ``build(days)`` returns fresh roll-up rows of those days from the stored calls.
    """
    def write(batch: DataFrame, _batch_id: int) -> None:
        days = batch.select(F.date_format(started, "yyyy-MM-dd").alias("date_key")).where("date_key is not null").distinct()
        storage.overwrite_days(build(days), path, touched=days)

    return write
