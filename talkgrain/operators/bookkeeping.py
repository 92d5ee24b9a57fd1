"""Runs, sessions, counters, follow-ups: small tables about the work itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.functions import paths, timing

FAILURES_KEPT = 50


def run_metrics(outcomes: DataFrame, keys: list[str], outcome: str = "outcome", values: list[str] | None = None) -> DataFrame:
    """Counts of each named outcome as columns."""
    names = values or []
    return outcomes.groupBy(*keys).agg(*[F.count_if(F.col(outcome) == v).alias(v) for v in names])


def latest_metrics(appended: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest value of every metric of a run from an append-only table."""
    by = [*(keys or ["run_id"]), "metric"]
    return appended.groupBy(*by).agg(F.max_by("value", "at").alias("value"))


def run_summary(appended: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per run, one column per metric, newest values."""
    return appended.groupBy("run_id").agg(*[
        F.max_by(F.when(F.col("metric") == m, F.col("value")), F.when(F.col("metric") == m, F.col("at"))).alias(m) for m in metrics])


def run_failures(failures: DataFrame, keep: int = FAILURES_KEPT) -> DataFrame:
    """How many failures a run had, and its first few.

    ``failures(run_id, seq, reason)`` with ``seq`` counting from 0 in a run: the first ones are a
    filter, so a run with millions of failures is not gathered.
    """
    counted = failures.groupBy("run_id").agg(F.count("*").alias("failure_count"))
    shown = (failures.where(F.col("seq") < keep).groupBy("run_id")
             .agg(F.array_sort(F.collect_list(F.struct("seq", "reason"))).alias("_f")))
    return (counted.join(shown, "run_id", "left")
            .select("run_id", "failure_count", F.transform("_f", lambda f: f["reason"]).alias("failures")))


def run_outcome(could_run: Column, failures: Column) -> Column:
    return F.when(~could_run, "FAILED").when(failures > 0, "PARTIAL").otherwise("OK")


def exit_code(outcome: Column) -> Column:
    return F.when(outcome == "FAILED", 2).when(outcome == "PARTIAL", 1).otherwise(0)


def session_counts(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """Processed and failed calls per session; failures of every stage count."""
    failed = F.col("outcome").isin("audit_failed", "audit_retryable", "ingest_failed")
    return outcomes.groupBy(*keys).agg(
        F.count_if(F.col("outcome") == "audited").alias("total_calls_processed"),
        F.count_if(failed).alias("calls_failed"),
        F.count_if(F.col("outcome") == "audit_skipped").alias("calls_skipped"))


def session_state(rows: DataFrame, key: str = "session_id") -> DataFrame:
    """One row per session: COMPLETED beats PENDING when both are there."""
    others = [c for c in rows.columns if c not in (key, "status")]
    return (rows.groupBy(key).agg(F.min_by(F.struct("status", *others), "status").alias("s"))
            .select(key, "s.status", *[F.col(f"s.{c}").alias(c) for c in others]))


def touched_days(calls: DataFrame, started: str = "started_at") -> DataFrame:
    """Days whose totals have to be built again, in order; unreadable starts are left out."""
    day = timing.date_key(started)
    return calls.select(day.alias("date_key")).where(F.col("date_key").isNotNull()).distinct().orderBy("date_key")


def with_parent(calls: DataFrame, audits: DataFrame, fields: list[str]) -> DataFrame:
    """Follow-ups with fields of the earlier call's audit, as ``parent_<field>``.

    A first call never looks.  A follow-up whose parent has no audit is kept, with
    ``parent_missing``.
    """
    named = audits.select(F.col("call_id").alias("parent_id"), F.lit(True).alias("_has"),
                          *[F.col(f).alias(f"parent_{f}") for f in fields])
    wanted = calls.withColumns({"is_follow_up_id": paths.is_follow_up("call_id"), "parent_id": paths.parent_call_id("call_id")})
    looked = (wanted.where(F.col("parent_id").isNotNull()).join(named, "parent_id", "left")
              .withColumn("parent_missing", F.col("is_follow_up_id") & F.col("_has").isNull()).drop("_has"))
    # first calls stay out of the join: without a parent they would all meet in one task
    none = {f"parent_{f}": F.lit(None).cast(audits.schema[f].dataType) for f in fields}
    firsts = wanted.where(F.col("parent_id").isNull()).withColumns(none | {"parent_missing": F.col("is_follow_up_id")})
    return looked.unionByName(firsts)


def string_metadata(metadata: Column) -> Column:
    """Keys in lower case, entries without a value left out, values as text."""
    kept = F.map_filter(metadata, lambda _k, v: v.isNotNull())
    return F.transform_values(F.transform_keys(kept, lambda k, _v: F.lower(k)), lambda _k, v: v.cast("string"))
