"""Queries: the streaming forms, run to completion over the driver tables as files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.catalog.log import ISO_SQL
from talkgrain.catalog.registry import query
from talkgrain.catalog.rollups import NUMBERS, day_rollup, keyed_calls
from talkgrain.catalog.tables import VIEWS, Inputs
from talkgrain.functions import timing
from talkgrain.operators import rollup
from talkgrain.session import checkpoint_folder
from talkgrain.sources import storage
from talkgrain.streaming import jobs


def _folder(t: Inputs) -> str:
    """A fresh folder where the cluster keeps its checkpoints."""
    return f"{checkpoint_folder(t.spark)}/stream-{uuid.uuid4().hex}"


def _stream(t: Inputs, table: str) -> DataFrame:
    schema = t.table(table).schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(t.folder)


def _view_stream(t: Inputs, view: str) -> DataFrame:
    for table in VIEWS[view].tables:
        _stream(t, table).createOrReplaceTempView(table)
    return t.spark.sql(VIEWS[view].spark)


def _run(t: Inputs, stream: DataFrame, mode: str = "append") -> DataFrame:
    """All of a stream's output, as a table."""
    base = _folder(t)
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(base + "/out")


def _drain(t: Inputs, stream: DataFrame, sink: Callable[[DataFrame, int], None]) -> None:
    (stream.writeStream.foreachBatch(sink).option("checkpointLocation", _folder(t)).trigger(availableNow=True).start().awaitTermination())


def _log_stream(t: Inputs) -> DataFrame:
    log = _view_stream(t, "v_log_raw")
    return log.withColumns({"callid": F.trim("callid"), "start_ts": F.col("start_ts").cast("timestamp")})


@query("stm_1_first_deliveries", "select callid from s_first")
def stm_1(t: Inputs) -> DataFrame:
    return _run(t, jobs.first_deliveries(_log_stream(t)).select("callid"))


@query("stm_2_late_rows", """
select callid, count(*) as copies from s_log where callid <> '' group by 1
""")
def stm_2(t: Inputs) -> DataFrame:
    """Rows within the watermark are all kept, repeats included."""
    kept = _log_stream(t).where("callid <> ''").withWatermark("start_ts", "1 hour").select("callid", "start_ts")
    return _run(t, kept).groupBy("callid").agg(F.count("*").alias("copies"))


# A window is given out when the watermark passes its end; the last one of a finite input stays open.
@query("stm_3_suspicious_slices", f"""
select {ISO_SQL.format("h")} as slice_start, row_count from (select date_trunc('hour', start_ts) as h, count(*) as row_count from v_log_raw group by 1) x
where row_count >= 15 and h + interval '1' hour <= (select max(start_ts) - interval '1' hour from v_log_raw)
""")
def stm_3(t: Inputs) -> DataFrame:
    found = _run(t, jobs.suspicious_slices(_log_stream(t), rows=15))
    return found.select(timing.iso_utc("slice_start").alias("slice_start"), "row_count")


@query("stm_4_business_days", """
select strftime(local_day, '%Y-%m-%d') as business_day, total_calls, audited_calls, scored_calls, total_flags, score_sum, total_duration_sec from (
  select date_trunc('day', started_at + interval '330' minute - interval '2' hour) as local_day, count(*) as total_calls, count(case when processing_status = 'PROCESSED' then 1 end) as audited_calls,
    count(score) as scored_calls, cast(sum(coalesce(flag_count, 0)) as bigint) as total_flags, round(coalesce(sum(score), 0), 4) as score_sum, cast(sum(duration_sec) as bigint) as total_duration_sec
  from v_calls group by 1) x
where local_day + interval '1' day + interval '2' hour - interval '330' minute <= (select max(started_at) - interval '6' hour from v_calls)
""")
def stm_4(t: Inputs) -> DataFrame:
    calls = _view_stream(t, "v_calls").withColumn("started_at", F.col("started_at").cast("timestamp"))
    return _run(t, jobs.business_day_totals(calls)).withColumn("score_sum", F.round("score_sum", 4))


@query("stm_5_stalled_ingests", f"""
select call_id, {ISO_SQL.format('moment')} as since from (select *, coalesce(status_at, started_at) as moment from v_calls) c where processing_status = 'INGESTING'
  and moment + interval '60' minute <= (select max(coalesce(status_at, started_at)) - interval '10' minute from v_calls)
""")
def stm_5(t: Inputs) -> DataFrame:
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    calls = _view_stream(t, "v_calls")
    changes = calls.select("call_id", "processing_status", *(F.col(c).cast("timestamp").alias(c) for c in ("status_at", "started_at")))
    return _run(t, jobs.stalled_by_session(changes)).select("call_id", timing.iso_utc("since").alias("since"))


@query("stm_6_insert_if_absent", "select callid from v_known union select callid from s_first")
def stm_6(t: Inputs) -> DataFrame:
    path = _folder(t) + "/calls"
    t.known.write.parquet(path)
    _drain(t, _log_stream(t).where("callid <> ''").select("callid"), jobs.insert_if_absent_batch(path, "callid"))
    return t.spark.read.parquet(path)


@query("stm_7_touched_days", f"""
select pk, date_key, {', '.join(NUMBERS)} from s_rollup where date_key in (select date_key from s_keyed_calls)
""")
def stm_7(t: Inputs) -> DataFrame:
    path = _folder(t) + "/rollups"
    calls = keyed_calls(t)
    changes = _view_stream(t, "v_calls").select("call_id", "started_at")
    # The stream above shares the table's name; the stored calls were read before it.
    _drain(t, changes, jobs.rebuild_touched_days(lambda days: rollup.rebuild_days(calls, days).select("pk", "date_key", *NUMBERS), path))
    return t.spark.read.parquet(path).select("pk", F.col("date_key").cast("string").alias("date_key"), *NUMBERS)


MOST_FLAGS = 3


@query("snk_5_manifest", f"""
select month_key, case when failed then 0 else written end as rows_written, case when failed then 0 else held end as rows_deleted, failed from (
  select left(date_key, 7) as month_key, count(*) filter (where total_calls > 1 or pk = 'OVERALL') as written, count(*) as held,
    coalesce(bool_or(total_flags > {MOST_FLAGS}) filter (where total_calls > 1 or pk = 'OVERALL'), false) as failed
  from s_rollup group by 1) x
""")
def snk_5_manifest(t: Inputs) -> DataFrame:
    """Stored parts built again with fewer rows; a part that holds a row with more flags than allowed is left as it was.

    Parts are months here: the tables have days of a call or two.
    """
    path = _folder(t) + "/months"
    stored = day_rollup(t).select("pk", "date_key", "total_calls", "total_flags", F.substring("date_key", 1, 7).alias("month_key"))
    storage.overwrite_days(stored, path, "month_key")
    fresh = t.spark.read.parquet(path).where("total_calls > 1 or pk = 'OVERALL'").select("pk", "date_key", "total_calls", "total_flags", F.col("month_key").cast("string").alias("month_key"))
    return storage.replace_days(fresh, path, stored.select("month_key").distinct(), "month_key", check=lambda _: F.col("total_flags") <= MOST_FLAGS)
