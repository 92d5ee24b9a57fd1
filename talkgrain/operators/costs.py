"""Token and audio costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkgrain import constants as K


def rate_card(spark: SparkSession, rows: tuple = K.RATE_CARD) -> DataFrame:
    """Dollars per million tokens; a fixed handful of rows."""
    return spark.createDataFrame(list(rows), "card string, rate_in double, rate_cached double, rate_out double, rate_write double")


def with_rates(usage: DataFrame, rows: tuple = K.RATE_CARD, model: str = "model") -> DataFrame:
    """Rates of the exact model, else of the longest listed name it starts with, else NULL.

    The card is a handful of literals, so the choice is one expression and needs no join.
    """
    by_length = sorted(rows, key=lambda r: -len(r[0]))
    card = F.when(F.lit(False), "")
    for row in rows:
        card = card.when(F.col(model) == row[0], row[0])
    for row in by_length:
        card = card.when(F.col(model).startswith(row[0]), row[0])
    priced = usage.withColumn("card", card)
    for place, name in enumerate(("rate_in", "rate_cached", "rate_out", "rate_write"), start=1):
        value = F.when(F.lit(False), F.lit(0.0))
        for row in rows:
            value = value.when(F.col("card") == row[0], F.lit(row[place]).cast("double"))
        priced = priced.withColumn(name, value)
    return priced


def flatten_usage(blocks: DataFrame, block: str = "usage") -> DataFrame:
    """Token counts of a usage block; the first cache-write count that is present counts.  A block without any count is no call."""
    prompt, done = f"{block}.prompt_tokens_details", f"{block}.completion_tokens_details"
    part = lambda c: F.nullif(F.col(c), F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    written = F.coalesce(part(f"{prompt}.cache_creation_tokens"), part(f"{prompt}.cache_write_tokens"),
                         part(f"{prompt}.cache_creation_input_tokens"), F.col(f"{block}.cache_creation_input_tokens"), zero)
    told = F.coalesce(*[F.col(c).cast("string") for c in (
        f"{block}.prompt_tokens", f"{block}.completion_tokens", f"{block}.cache_creation_input_tokens", prompt, done)])
    return blocks.where(told.isNotNull()).withColumns({
        "prompt_tokens": F.coalesce(f"{block}.prompt_tokens", zero),
        "cached_tokens": F.coalesce(f"{prompt}.cached_tokens", zero),
        "completion_tokens": F.coalesce(f"{block}.completion_tokens", zero),
        "reasoning_tokens": F.coalesce(f"{done}.reasoning_tokens", zero),
        "cache_write_tokens": written})


TOKENS = ("prompt_tokens", "cached_tokens", "completion_tokens", "reasoning_tokens", "cache_write_tokens")


def ledger(usage: DataFrame, keys: list[str]) -> DataFrame:
    """Token sums per key; a plain partial aggregation."""
    present = [c for c in TOKENS if c in usage.columns]
    return usage.groupBy(*keys).agg(F.count("*").alias("calls"), *[F.sum(c).alias(c) for c in present])


def derived_tokens(ledgers: DataFrame) -> DataFrame:
    """Uncached and fresh prompt tokens and the cache hit rate."""
    zero = F.lit(0).cast("bigint")
    return (ledgers.withColumn("uncached_tokens", F.greatest(zero, F.col("prompt_tokens") - F.col("cached_tokens")))
            .withColumn("fresh_tokens", F.greatest(zero, F.col("uncached_tokens") - F.col("cache_write_tokens")))
            .withColumn("cache_hit_rate", F.coalesce(F.round(F.try_divide("cached_tokens", "prompt_tokens"), 4), F.lit(0.0))))


def cost_usd(write: Column | str = "cache_write_tokens") -> Column:
    """Dollars of a ledger row with rates; NULL without rates.  Writes without a rate cost as input."""
    writes = F.least(write, "uncached_tokens")
    return (F.col("fresh_tokens") * F.col("rate_in") + writes * F.coalesce("rate_write", "rate_in")
            + F.col("cached_tokens") * F.col("rate_cached") + F.col("completion_tokens") * F.col("rate_out")) / 1_000_000.0


def priced(usage: DataFrame, keys: list[str], digits: int = 6) -> DataFrame:
    """Ledger, derived counts and dollars per key; ``model`` is one of the keys."""
    return with_rates(derived_tokens(ledger(usage, keys))).withColumn("cost_usd", F.round(cost_usd(), digits))


def audio_cost(calls: DataFrame, model: str = "stt_model", duration: str = "duration_ms", digits: int = 6) -> DataFrame:
    """Audio is billed by the hour; an unlisted model takes the default rate."""
    rate = F.when(F.lit(False), F.lit(0.0))
    for name, value in K.AUDIO_RATES.items():
        rate = rate.when(F.col(model) == name, F.lit(value))
    length = F.coalesce(F.col(duration), F.lit(0))
    return calls.withColumn("usd_per_hour", rate.otherwise(F.lit(K.AUDIO_DEFAULT_RATE))).withColumns({
        "audio_seconds": F.round(length / 1000.0, 2),
        "audio_cost_usd": F.round(length / 3_600_000.0 * F.col("usd_per_hour"), digits)})


def combined(costs: DataFrame, keys: list[str], cost: str = "cost_usd") -> DataFrame:
    """Total dollars per key; unknown costs are left out, all unknown is NULL."""
    return costs.groupBy(*keys).agg(F.sum(cost).alias("total_usd"))


def stage_totals(calls: DataFrame, audio: DataFrame, analysis: DataFrame, audit: DataFrame) -> DataFrame:
    """One row per call and stage, whatever models the stage used.

    ``analysis`` carries a stored ``total_usd`` or ``cost_usd``, or else usage priced again as
    ``recomputed_usd``; a call missing from a stage's table has no such stage.
    """
    # a call itself is a row without a stage: one aggregate by call in place of a join for each stage
    by_call = _by_call({"": calls, "transcribe": audio, "analyse": analysis, "audit": audit})
    told = F.array_compact(F.array(*[
        F.when(F.col(f"_has_{name}"), F.struct(F.lit(name).alias("stage"), F.col(f"_usd_{name}").alias("stage_usd"))) for name in STAGE_COSTS]))
    return by_call.where("_has_").select("call_id", F.explode(told).alias("s")).select("call_id", "s.*")


# Where each stage's dollars may be, best first.
STAGE_COSTS = {"transcribe": ("total_usd", "cost_usd", "audio_cost_usd"), "analyse": ("total_usd", "cost_usd", "recomputed_usd"), "audit": ("total_usd", "cost_usd")}


def _stage_usd(df: DataFrame, stage: str) -> Column:
    none = F.lit(None).cast("double")
    return F.coalesce(none, *[F.col(n) for n in STAGE_COSTS.get(stage, ()) if n in df.columns])


def _by_call(tables: dict[str, DataFrame]) -> DataFrame:
    """A row per call of any table: whether each stage has rows of it (_has_<stage>) and their dollars (_usd_<stage>)."""
    rows = None
    for stage, df in tables.items():
        part = df.where(F.col("call_id").isNotNull()).select("call_id", F.lit(stage).alias("stage"), _stage_usd(df, stage).alias("stage_usd"))
        rows = part if rows is None else rows.unionByName(part)
    of = {stage: F.col("stage") == stage for stage in tables}
    return rows.groupBy("call_id").agg(*[F.bool_or(test).alias(f"_has_{stage}") for stage, test in of.items()],
                                       *[F.sum(F.when(test, F.col("stage_usd"))).alias(f"_usd_{stage}") for stage, test in of.items() if stage])


def call_costs(stages: DataFrame, durations: DataFrame, digits: int = 6) -> DataFrame:
    """Total per call, whether every stage was measured, dollars per hour of audio."""
    has = lambda name: F.coalesce(F.bool_or(F.col("stage") == name), F.lit(False))
    total = stages.groupBy("call_id").agg(
        F.coalesce(F.sum("stage_usd"), F.lit(0.0)).alias("_raw"),
        ((F.count("stage_usd") == F.count("*")) & has("transcribe") & has("analyse")).alias("complete"))
    return _per_hour(total.join(durations.select("call_id", "duration_ms"), "call_id", "left"), digits)


def _per_hour(totals: DataFrame, digits: int) -> DataFrame:
    hours = F.nullif(F.col("duration_ms"), F.lit(0).cast("bigint")) / 3_600_000.0
    # both are rounded from the raw sum: a rounded total of a short call would be off by much in an hour; a tie goes as the product in doubles has it
    return totals.withColumns({
        "total_usd": F.round("_raw", digits),
        "audio_seconds": F.round(F.coalesce("duration_ms", F.lit(0)) / 1000.0, 2),
        "usd_per_audio_hour": F.round(F.col("_raw") / hours * 10_000.0) / 10_000.0}).drop("_raw")


def audio_call_costs(audio: DataFrame, analysis: DataFrame, audit: DataFrame, digits: int = 6) -> DataFrame:
    """call_costs of the stage_totals of the calls in ``audio``, whose rows also hold the durations.

    Each table is shuffled once and ``audio`` is sorted once: a call's rows of it are summed where the join has put them side by side.
    """
    spent = _by_call({"analyse": analysis, "audit": audit})
    joined = audio.where(F.col("call_id").isNotNull()).select("call_id", "duration_ms", _stage_usd(audio, "transcribe").alias("_usd")).join(spent, "call_id", "left")
    heard = F.sum("_usd").over(Window.partitionBy("call_id"))
    rows = joined.withColumn("_usd_transcribe", heard).withColumn(
        "_raw", sum((F.coalesce(f"_usd_{name}", F.lit(0.0)) for name in STAGE_COSTS), F.lit(0.0)))
    measured = F.col("_usd_transcribe").isNotNull() & F.col("_usd_analyse").isNotNull() & (~F.coalesce("_has_audit", F.lit(False)) | F.col("_usd_audit").isNotNull())
    return _per_hour(rows.select("call_id", "_raw", measured.alias("complete"), "duration_ms"), digits)
