"""Queries: token usage and costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.operators import costs

# Dollars are kept to nine digits and compared in whole billionths: no ties to round.
DIGITS = 9
_NANO = "cast(round({0} * 1e9) as bigint)"


def _nano(column: str):
    return F.round(F.col(column) * 1e9).cast("bigint")


_NUM = lambda v: "null" if v is None else f"{v}e0"
_CARD = ", ".join(f"('{r[0]}', {', '.join(_NUM(v) for v in r[1:])})" for r in K.RATE_CARD)
step("s_card", f"select * from (values {_CARD}) c(card, rate_in, rate_cached, rate_out, rate_write)")
step("s_models", """
select model, arg_max(card, case when card = model then 1000 else length(card) end) as card from (select distinct model from v_usage) u join s_card c on starts_with(u.model, c.card) group by 1
""")


def ledger_sql(keys: str) -> str:
    return f"""
select x.*, c.card, case when c.card is not null then round((fresh_tokens * rate_in + least(cache_write_tokens, uncached_tokens) * coalesce(rate_write, rate_in)
    + cached_tokens * rate_cached + completion_tokens * rate_out) / 1000000.0e0, 9) end as cost_usd
from (select *, greatest(0, uncached_tokens - cache_write_tokens) as fresh_tokens from (
  select *, greatest(0, prompt_tokens - cached_tokens) as uncached_tokens, coalesce(round(cached_tokens / nullif(cast(prompt_tokens as double), 0), 4), 0) as cache_hit_rate from (
    select {keys}, count(*) as calls, cast(sum(prompt_tokens) as bigint) as prompt_tokens, cast(sum(cached_tokens) as bigint) as cached_tokens, cast(sum(completion_tokens) as bigint) as completion_tokens,
      cast(sum(reasoning_tokens) as bigint) as reasoning_tokens, cast(sum(cache_write_tokens) as bigint) as cache_write_tokens from v_usage group by {keys}) a) b) x
left join s_models m on x.model = m.model left join s_card c on m.card = c.card
"""


step("s_ledger", ledger_sql("user_id, model, stage"))
step("s_call_ledger", ledger_sql("call_id, model, stage"))


def usage_blocks(t: Inputs) -> DataFrame:
    """Usage as the provider reports it: nested blocks, the cache writes under one of several names."""
    u = t.usage
    n = F.col("call_id") % 4
    details = F.struct(F.col("cached_tokens").alias("cached_tokens"), F.when(n == 0, F.col("cache_write_tokens")).alias("cache_creation_tokens"),
                       F.when(n == 1, F.col("cache_write_tokens")).alias("cache_write_tokens"), F.when(n == 2, F.col("cache_write_tokens")).alias("cache_creation_input_tokens"))
    block = F.to_json(F.struct("prompt_tokens", "completion_tokens", details.alias("prompt_tokens_details"),
                               F.struct("reasoning_tokens").alias("completion_tokens_details"), F.when(n == 3, F.col("cache_write_tokens")).alias("cache_creation_input_tokens")))
    return u.select("call_id", "user_id", "model", "stage", F.from_json(block, schemas.USAGE).alias("usage"))


def usage(t: Inputs) -> DataFrame:
    return costs.flatten_usage(usage_blocks(t)).drop("usage")


_SUMS = "calls, prompt_tokens, cached_tokens, completion_tokens, reasoning_tokens, cache_write_tokens"


@query("jn_13_rate_lookup", "select call_id, v.model, c.card, rate_in, rate_cached, rate_out, rate_write from v_usage v left join s_models m on v.model = m.model left join s_card c on m.card = c.card")
def jn_13(t: Inputs) -> DataFrame:
    return costs.with_rates(t.usage).select("call_id", "model", "card", "rate_in", "rate_cached", "rate_out", "rate_write")


@query("ag_18_usage_ledger", f"select user_id, model, stage, {_SUMS} from s_ledger")
def ag_18(t: Inputs) -> DataFrame:
    return costs.ledger(usage(t), ["user_id", "model", "stage"])


@query("ag_19_derived_tokens", "select user_id, model, stage, uncached_tokens, fresh_tokens, cache_hit_rate from s_ledger")
def ag_19(t: Inputs) -> DataFrame:
    return costs.derived_tokens(costs.ledger(usage(t), ["user_id", "model", "stage"])).select("user_id", "model", "stage", "uncached_tokens", "fresh_tokens", "cache_hit_rate")


@query("ag_20_token_cost", f"select user_id, model, stage, {_NANO.format('cost_usd')} as cost_nano_usd from s_ledger")
def ag_20(t: Inputs) -> DataFrame:
    return costs.priced(usage(t), ["user_id", "model", "stage"], DIGITS).select("user_id", "model", "stage", _nano("cost_usd").alias("cost_nano_usd"))


_AUDIO = """
select cast(call_id as bigint) as call_id, stt_model, duration_ms, rate as usd_per_hour, round(duration_ms / 1000.0e0, 2) as audio_seconds, round(duration_ms / 3600000.0e0 * rate, 9) as audio_cost_usd
from (select *, case stt_model when 'stt-async-v5' then 0.10e0 when 'stt-rt-v3' then 0.12e0 else 0.10e0 end as rate from (
  select call_id, duration_sec * 1000 as duration_ms, case call_direction when 'INBOUND' then 'stt-rt-v3' else 'stt-async-v5' end as stt_model from v_calls) x) y
"""
step("s_audio", _AUDIO)


def audio(t: Inputs) -> DataFrame:
    model = F.when(F.col("call_direction") == "INBOUND", "stt-rt-v3").otherwise("stt-async-v5")
    return costs.audio_cost(t.calls.select(F.col("call_id").cast("bigint").alias("call_id"), (F.col("duration_sec") * 1000).alias("duration_ms"), model.alias("stt_model")), digits=DIGITS)


@query("ag_21_audio_cost", f"select call_id, stt_model, usd_per_hour, audio_seconds, {_NANO.format('audio_cost_usd')} as audio_nano_usd from s_audio")
def ag_21(t: Inputs) -> DataFrame:
    return audio(t).select("call_id", "stt_model", "usd_per_hour", "audio_seconds", _nano("audio_cost_usd").alias("audio_nano_usd"))


@query("ag_22_combined_cost", f"select user_id, {_NANO.format('sum(cost_usd)')} as total_nano_usd from s_ledger group by 1")
def ag_22(t: Inputs) -> DataFrame:
    whole = costs.combined(costs.priced(usage(t), ["user_id", "model", "stage"], DIGITS), ["user_id"])
    return whole.select("user_id", _nano("total_usd").alias("total_nano_usd"))


_STAGES = """
select call_id, stage, sum(stage_usd) as stage_usd from (
select call_id, 'transcribe' as stage, audio_cost_usd as stage_usd from s_audio
union all select call_id, 'analyse', cost_usd from s_call_ledger where stage = 'analyse' and call_id in (select call_id from s_audio)
union all select call_id, 'audit', cost_usd from s_call_ledger where stage = 'audit' and call_id in (select call_id from s_audio)) x group by 1, 2
"""
step("s_stages", _STAGES)


def verdict_costs(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Analyses carry their stored cost; priced again where the block is from before costs were kept.  Then the audits."""
    by_call = costs.priced(usage(t), ["call_id", "model", "stage"], DIGITS)
    analysis = by_call.where("stage = 'analyse'").select(
        "call_id", F.when(F.col("call_id") % 2 == 0, F.col("cost_usd")).alias("cost_usd"), F.col("cost_usd").alias("recomputed_usd"))
    return analysis, by_call.where("stage = 'audit'").select("call_id", "cost_usd")


def stages(t: Inputs) -> DataFrame:
    return costs.stage_totals(audio(t), audio(t), *verdict_costs(t))


@query("jn_14_stage_costs", f"select call_id, stage, {_NANO.format('stage_usd')} as stage_nano_usd from s_stages")
def jn_14(t: Inputs) -> DataFrame:
    return stages(t).select("call_id", "stage", _nano("stage_usd").alias("stage_nano_usd"))


@query("ag_23_call_costs", f"""
select s.call_id, {_NANO.format('total')} as total_nano_usd, complete, round(duration_ms / 1000.0e0, 2) as audio_seconds, duration_ms > 0 as has_hourly_rate
from (select call_id, coalesce(sum(stage_usd), 0) as total, count(stage_usd) = count(*) and count(case when stage in ('transcribe', 'analyse') then 1 end) = 2 as complete from s_stages group by 1) s
join s_audio a on s.call_id = a.call_id
""")
def ag_23(t: Inputs) -> DataFrame:
    whole = costs.audio_call_costs(audio(t), *verdict_costs(t), DIGITS)
    return whole.select("call_id", _nano("total_usd").alias("total_nano_usd"), "complete", "audio_seconds", F.col("usd_per_audio_hour").isNotNull().alias("has_hourly_rate"))


@query("ag_23_hourly_rate", f"""
select s.call_id, round(total / (duration_ms / 3600000.0e0), 4) as usd_per_audio_hour from (select call_id, coalesce(sum(stage_usd), 0) as total from s_stages group by 1) s
join s_audio a on s.call_id = a.call_id where duration_ms > 0
""")
def ag_23_rate(t: Inputs) -> DataFrame:
    whole = costs.audio_call_costs(audio(t), *verdict_costs(t), DIGITS).where("usd_per_audio_hour is not null")
    return whole.select("call_id", "usd_per_audio_hour")
