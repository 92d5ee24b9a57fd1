"""From fetched log rows to the work list: dedup, piles, counters, cap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import text

PILES = ("already_known", "off_roster", "skipped", "to_do")


def first_arrivals(log: DataFrame, arrival: tuple[str, ...] = ("arrival",), key: str = "callid") -> DataFrame:
    """The first row of each call id; rows without an id are dropped.

    An aggregate, not a window: a call id delivered millions of times is reduced before the shuffle.
    """
    others = [c for c in log.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*arrival)).alias("r")
    return (log.where(F.col(key) != "").groupBy(key).agg(first, F.count("*").alias("deliveries"))
            .select(key, *[F.col(f"r.{c}").alias(c) for c in others], "deliveries"))


def dispositions(rows: DataFrame, known: DataFrame, keys: DataFrame, key: str = "callid",
                 extension: str = "agent_extension") -> DataFrame:
    """The pile of each distinct call, first match wins: known, off roster, not auditable, to do."""
    stored = known.select(F.col(key)).distinct().withColumn("_known", F.lit(True))
    listed = keys.select(F.col("key").alias("_key")).withColumn("_listed", F.lit(True))
    joined = (rows.join(stored, key, "left")
              .join(listed, text.strip(F.col(extension)) == F.col("_key"), "left"))
    reason = F.concat(F.coalesce(text.blank_to_null("call_status"), F.lit("unknown status")),
                      F.when(F.col("recording_url") == "", ", no recording").otherwise(""))
    pile = (F.when(F.col("_known"), "already_known").when(F.col("_listed").isNull(), "off_roster")
            .when(~F.col("is_auditable"), "skipped").otherwise("to_do"))
    return (joined.withColumn("pile", pile)
            .withColumn("skip_reason", F.when(F.col("pile") == "skipped", reason)).drop("_known", "_key", "_listed"))


def collection_counts(piled: DataFrame, failed_slices: int = 0) -> DataFrame:
    """One row of counters over the piled calls."""
    counters = [F.count_if(F.col("pile") == pile).alias(pile) for pile in PILES]
    return piled.agg(F.count("*").alias("fetched"),
                     F.coalesce(F.sum(F.col("deliveries") - 1), F.lit(0)).alias("duplicates"),
                     *counters, F.lit(failed_slices).cast("bigint").alias("failed_slices"))


def top_off_roster(piled: DataFrame, limit: int = 15) -> DataFrame:
    return (piled.where(F.col("pile") == "off_roster")
            .groupBy(F.coalesce(text.blank_to_null("agent_extension"), F.lit("?")).alias("extension"))
            .agg(F.count("*").alias("call_count")).orderBy(F.desc("call_count"), "extension").limit(limit))


def skip_reasons(piled: DataFrame) -> DataFrame:
    return (piled.where(F.col("pile") == "skipped").groupBy("skip_reason")
            .agg(F.count("*").alias("call_count")).orderBy(F.desc("call_count"), "skip_reason"))


def capped(piled: DataFrame, limit: int) -> DataFrame:
    """The oldest ``limit`` calls to do; the rest wait for the next run."""
    return piled.where(F.col("pile") == "to_do").orderBy("started_at", "callid").limit(limit)


def audit_batch(inputs: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """Calls with a transcript and no audit yet, first calls in level 0, follow-ups in level 1."""
    from talkgrain.functions import paths

    todo = inputs if force else inputs.join(outputs.select("call_id"), "call_id", "left_anti")
    follow = paths.is_follow_up("call_id")
    return todo.withColumns({"level": follow.cast("int"),
                             "parent_id": paths.parent_call_id("call_id"),
                             "sort_id": F.coalesce(paths.parent_call_id("call_id"), F.col("call_id"))})
