"""Sinks: day-partitioned artifacts, insert-if-absent, idempotent day rebuilds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain.functions import paths


def with_day_parts(df: DataFrame, started: str = "started_at") -> DataFrame:
    """``yyyy``, ``mm``, ``dd`` of the call's own start, never of today."""
    return df.withColumns({"yyyy": F.date_format(started, "yyyy"), "mm": F.date_format(started, "MM"),
                           "dd": F.date_format(started, "dd")})


def write_artifacts(df: DataFrame, path: str, started: str = "started_at", file_format: str = "json",
                    run: str | None = None, parts: int = 4) -> None:
    """``<kind>/<yyyy>/<mm>/<dd>``, and below it ``run=<run>`` where a run is named.

    One shuffle on kind and day keeps the files of a day to ``parts``, over which a large day is
    spread.  A named run replaces what it wrote before, so it may be tried again; without a name
    rows are appended.
    """
    days = ["kind", "yyyy", "mm", "dd"]
    dealt = with_day_parts(df, started).withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
    dealt = dealt.repartition(*days, "_part").drop("_part")
    if run is None:
        dealt.write.mode("append").partitionBy(*days).format(file_format).save(path)
    else:
        (dealt.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*days, "run").format(file_format).save(path))


def owned_keys(calls: DataFrame) -> DataFrame:
    return (calls.select("call_id", F.explode(paths.every_key("call_id", "started_at")).alias("o"))
            .select("call_id", "o.kind", "o.key"))


def split_by_presence(new: DataFrame, existing: DataFrame, key: str = "call_id") -> DataFrame:
    """``new`` with ``accepted``: true where the key is not stored yet, for one row of each key."""
    marked = existing.groupBy(key).agg(F.lit(True).alias("_stored"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*[c for c in new.columns if c != key] or [key]))
    joined = new.withColumn("_nth", nth).join(marked, key, "left")
    return joined.withColumn("accepted", F.col("_stored").isNull() & (F.col("_nth") == 1)).drop("_stored", "_nth")


def one_per_key(new: DataFrame, key: str = "call_id") -> DataFrame:
    """The least row of each key, by all its columns: the same one however often it is asked for."""
    rest = [c for c in new.columns if c != key]
    if not rest:
        return new.distinct()
    return new.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(*new.columns)


def insert_if_absent(new: DataFrame, existing: DataFrame, path: str, key: str = "call_id") -> None:
    """A key that comes twice in ``new`` is written once."""
    one_per_key(new, key).join(existing, key, "left_anti").write.mode("append").parquet(path)


NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # where Spark's writer puts rows without a day


def overwrite_days(df: DataFrame, path: str, day: str = "date_key", touched: DataFrame | None = None) -> None:
    """Replace just the days present in ``df``; the days' stale rows go with their partitions.

    ``touched`` has the days that were rebuilt: one of them without a row in ``df`` is emptied.
    Rows meet by day first, so that a day is one file; the count is fixed so that days are written
    side by side even when they are small.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(tasks, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path))
    if touched is not None:
        emptied = touched.select(F.col(day).cast("string").alias(day)).distinct().exceptAll(df.select(F.col(day).cast("string").alias(day)).distinct())
        spark = df.sparkSession
        for row in emptied.toLocalIterator():  # a name for each day of the rebuild at most
            folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"{day}={NO_DAY if row[day] is None else row[day]}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_days(fresh: DataFrame, path: str, touched: DataFrame, day: str = "date_key", check: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Replace the touched days one by one, each whole or not at all, and say what became of it.

    Rows are staged beside the table, a folder a day.  A day whose staged rows fail ``check`` (a condition on each row), or which can't be
    published, leaves its stored rows and every other day as they are.  Returns a manifest, (day, rows_written, rows_deleted, failed), that is
    also added to the table's ``_manifest``.  A day counts as published once its folder is in place: a run that is broken off may be
    started again.  Stored rows are those the day had; the driver handles names and counts of days, never rows.
    """
    spark = fresh.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    store = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    run = f"{path}/_staged/{uuid.uuid4().hex}"
    days = touched.select(F.col(day).cast("string").alias(day)).where(F.col(day).isNotNull()).distinct()
    rows = fresh.withColumn(day, F.col(day).cast("string")).join(days, day, "left_semi")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(tasks, day).write.partitionBy(day).parquet(run)

    schema = T.StructType([f for f in fresh.schema.fields if f.name != day] + [T.StructField(day, T.StringType())])
    bad = F.lit(0) if check is None else F.when(F.coalesce(check(fresh), F.lit(False)), 0).otherwise(1)
    staged = spark.read.schema(schema).parquet(run).groupBy(day).agg(F.count("*").alias("rows_written"), F.sum(bad).alias("_bad"))
    if store.exists(fs_path(path)) and any(s.getPath().getName().startswith(f"{day}=") for s in store.listStatus(fs_path(path))):
        held = spark.read.schema(T.StructType([T.StructField(day, T.StringType())])).parquet(path).join(F.broadcast(days), day).groupBy(day).agg(F.count("*").alias("rows_deleted"))
    else:
        held = days.where("false").withColumn("rows_deleted", F.lit(0).cast("bigint"))
    told = days.join(staged, day, "left").join(held, day, "left").na.fill(0).collect()  # one row a day

    manifest = []
    for row in sorted(told, key=lambda r: r[day]):
        home, made = fs_path(path, f"{day}={row[day]}"), fs_path(run, f"{day}={row[day]}")
        failed = row["_bad"] > 0
        if not failed:
            store.delete(home, True)
            failed = row["rows_written"] > 0 and not store.rename(made, home)
        manifest.append((row[day], 0 if failed else row["rows_written"], 0 if failed else row["rows_deleted"], failed))
    store.delete(fs_path(run), True)
    out = spark.createDataFrame(manifest, f"{day} string, rows_written long, rows_deleted long, failed boolean")
    out.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/_manifest")
    return out


def stale_rows(existing: DataFrame, fresh: DataFrame, keys: tuple[str, ...] = ("pk", "date_key"), touched: DataFrame | None = None, day: str = "date_key") -> DataFrame:
    """Stored rows of the rebuilt days that the rebuild did not write again.

    ``touched`` has the rebuilt days; without it ``existing`` must hold no others.
    """
    if touched is not None:
        existing = existing.join(touched.select(day).distinct(), day, "left_semi")
    return existing.select(*keys).join(fresh.select(*keys), list(keys), "left_anti")


def rebuild_counts(fresh: DataFrame, stale: DataFrame, day: str = "date_key") -> DataFrame:
    """Rows written and deleted per day."""
    written = fresh.select(day, F.lit(1).alias("w"), F.lit(0).alias("d"))
    deleted = stale.select(day, F.lit(0).alias("w"), F.lit(1).alias("d"))
    return written.unionByName(deleted).groupBy(day).agg(
        F.sum("w").alias("rows_written"), F.sum("d").alias("rows_deleted"))


def attach_transcript(audits: DataFrame, turns: DataFrame) -> DataFrame:
    """Each audit with its whole conversation as nested turns: one document per call, as it is read."""
    nested = turns.groupBy("call_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "speaker", "text", "start_ms", "end_ms"))).alias("transcript"))
    return audits.join(nested, "call_id", "left")
