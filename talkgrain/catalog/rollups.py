"""Queries: day roll-ups, spans, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.catalog.log import resolved_roster
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.functions import timing
from talkgrain.operators import agents, bookkeeping, rollup
from talkgrain.sources import storage

FROM, TO = "1996-01-01", "1998-12-31"

_SLUG = "coalesce(nullif(trim(lower(regexp_replace({0}, '[^a-zA-Z0-9]+', '-', 'g')), '-'), ''), 'unknown')"

step("s_agent_keys", f"""
select extension, team, case when count(*) over (partition by team, name_slug) > 1 then concat(name_slug, '-', extension) else name_slug end as agent_key
from (select extension, case when state = '' then 'UNASSIGNED' else state end as team, {_SLUG.format('name')} as name_slug from s_roster) x
""")
step("s_keyed_calls", f"""
select c.*, strftime(started_at, '%Y-%m-%d') as date_key, coalesce(k.team, 'UNASSIGNED') as team,
  coalesce(k.agent_key, {_SLUG.format("coalesce(agent_name, '')")}) as agent_key
from v_calls c left join s_agent_keys k on c.agent_extension = k.extension
""")
_PK = "case scope when 'OVERALL' then 'OVERALL' when 'TEAM' then concat('TEAM#', team) else concat('AGENT#', team, '#', agent_key) end as pk"
_SCOPE = "case when grouping(team) = 1 then 'OVERALL' when grouping(agent_key) = 1 then 'TEAM' else 'AGENT' end as scope"
_SETS = "group by grouping sets ((date_key{0}), (date_key, team{0}), (date_key, team, agent_key{0}))"
step("s_rollup", f"""
select *, {_PK} from (
select date_key, team, agent_key, {_SCOPE}, count(*) as total_calls, count_if(processing_status = 'PROCESSED') as audited_calls, count(score) as scored_calls,
  cast(sum(coalesce(flag_count, 0)) as bigint) as total_flags, count_if(coalesce(flag_count, 0) > 0) as flagged_calls,
  count_if(coalesce(disqualified, false)) as fatal_calls, count_if(coalesce(flag_count, 0) > 0 and not coalesce(disqualified, false)) as review_calls,
  round(coalesce(sum(score), 0), 4) as score_sum, max(score) as score_max, min(score) as score_min, cast(sum(duration_sec) as bigint) as total_duration_sec,
  count_if(coalesce(audit_status, '') = 'HIGH') as high_calls, count_if(coalesce(audit_status, '') = 'MEDIUM') as medium_calls, count_if(coalesce(audit_status, '') = 'LOW') as low_calls
from s_keyed_calls {_SETS.format('')}) r
""")
step("s_metrics", f"""
select *, {_PK} from (
select date_key, team, agent_key, criterion, {_SCOPE}, nullif(round(cast(sum(awarded) as double), 4), 0) as metric_sum, count(awarded) as metric_count
from s_keyed_calls c join v_marks m on c.call_id = m.call_id {_SETS.format(', criterion')}) r
""")

NUMBERS = [*rollup.SUMS, "score_max", "score_min"]


def keyed_calls(t: Inputs) -> DataFrame:
    return agents.with_rollup_key(t.calls, agents.rollup_keys(resolved_roster(t)))


def day_rollup(t: Inputs) -> DataFrame:
    return rollup.day_rollup(rollup.agent_days(keyed_calls(t)))


@query("jn_5_rollup_key_join", "select call_id, team, agent_key from s_keyed_calls")
def jn_5(t: Inputs) -> DataFrame:
    return keyed_calls(t).select("call_id", "team", "agent_key")


@query("ag_7_agent_keys", "select extension, team, agent_key from s_agent_keys")
def ag_7(t: Inputs) -> DataFrame:
    return agents.rollup_keys(resolved_roster(t))


@query("src_8_rollup_row", "select pk, date_key, total_calls, total_flags from s_rollup where concat(pk, date_key) in (select concat('OVERALL', strftime(started_at, '%Y-%m-%d')) from v_calls where flag_count > 0 union select concat(pk, date_key) from s_rollup where total_flags > 1)")
def src_8_row(t: Inputs) -> DataFrame:
    """The floor's rows of days with a flag, and the rows of any scope with more than one."""
    stored = day_rollup(t)
    floor = t.calls.where("flag_count > 0").select(F.lit("OVERALL").alias("pk"), F.date_format("started_at", "yyyy-MM-dd").alias("date_key"))
    wanted = floor.unionByName(stored.where("total_flags > 1").select("pk", "date_key"))
    return rollup.rows_of(stored, wanted).select("pk", "date_key", "total_calls", "total_flags")


@query("ag_1_day_rollup", f"select pk, date_key, scope, {', '.join(NUMBERS)} from s_rollup")
def ag_1(t: Inputs) -> DataFrame:
    return day_rollup(t).select("pk", "date_key", "scope", *NUMBERS)


@query("ag_2_status_counts", f"""
select pk, date_key, status, call_count from (select *, {_PK} from (
select date_key, team, agent_key, coalesce(nullif(processing_status, ''), 'UNKNOWN') as status, {_SCOPE}, count(*) as call_count
from s_keyed_calls group by grouping sets ((date_key, processing_status), (date_key, team, processing_status), (date_key, team, agent_key, processing_status))) r) x
""")
def ag_2(t: Inputs) -> DataFrame:
    return rollup.status_counts(keyed_calls(t)).select("pk", "date_key", "status", "call_count")


@query("ag_3_severity_counts", """
select pk, date_key, severity, call_count from (
  select pk, date_key, 'HIGH' as severity, high_calls as call_count from s_rollup union all
  select pk, date_key, 'MEDIUM', medium_calls from s_rollup union all select pk, date_key, 'LOW', low_calls from s_rollup) x where call_count > 0
""")
def ag_3(t: Inputs) -> DataFrame:
    return rollup.severity_map(day_rollup(t)).select("pk", "date_key", F.explode("severity_calls").alias("severity", "call_count"))


@query("ag_4_metric_totals", "select pk, date_key, criterion, metric_sum, metric_count from s_metrics")
def ag_4(t: Inputs) -> DataFrame:
    return rollup.metric_totals(keyed_calls(t), t.marks).select("pk", "date_key", "criterion", "metric_sum", "metric_count")


@query("ag_5_agent_labels", """
select date_key, concat('AGENT#', team, '#', agent_key) as pk, agent_name as label_name, agent_extension as label_extension
from (select *, row_number() over (partition by date_key, team, agent_key order by started_at desc, call_id desc) as rn from s_keyed_calls) x where rn = 1
""")
def ag_5(t: Inputs) -> DataFrame:
    keyed = keyed_calls(t)
    labelled = rollup.with_labels(rollup.day_rollup(rollup.agent_days(keyed)), keyed)
    return labelled.where("scope = 'AGENT'").select("date_key", "pk", "label_name", "label_extension")


@query("ag_6_rollup_keys", "select pk, date_key, scope, coalesce(team, '') as team, coalesce(agent_key, '') as agent_key from s_rollup")
def ag_6(t: Inputs) -> DataFrame:
    return rollup.split_rollup_key(day_rollup(t).select("pk", "date_key")).select("pk", "date_key", "scope", "team", "agent_key")


_SPAN = f"""
select pk, count(*) as days, cast(sum(total_calls) as bigint) as total_calls, cast(sum(scored_calls) as bigint) as scored_calls, cast(sum(total_flags) as bigint) as total_flags,
  cast(sum(fatal_calls) as bigint) as fatal_calls, round(sum(score_sum), 4) as score_sum, max(score_max) as score_max, min(score_min) as score_min,
  round(sum(score_sum) / nullif(sum(scored_calls), 0), 4) as score_mean
from s_rollup where date_key between '{FROM}' and '{TO}' group by pk
"""
step("s_span", _SPAN)
_SPAN_COLUMNS = ["pk", "days", "total_calls", "scored_calls", "total_flags", "fatal_calls", "score_sum", "score_max", "score_min", "score_mean"]


@query("ag_8_span", f"select {', '.join(_SPAN_COLUMNS)} from s_span")
def ag_8(t: Inputs) -> DataFrame:
    return rollup.span(day_rollup(t), FROM, TO).select(*_SPAN_COLUMNS)


@query("ag_8_metric_span", f"""
select pk, criterion, sum(coalesce(metric_sum, 0)) as metric_sum, cast(sum(metric_count) as bigint) as metric_count,
  round(sum(coalesce(metric_sum, 0)) / sum(metric_count), 4) as metric_mean from s_metrics where date_key between '{FROM}' and '{TO}' group by 1, 2
""")
def ag_8_metrics(t: Inputs) -> DataFrame:
    return rollup.metric_span(rollup.metric_totals(keyed_calls(t), t.marks), FROM, TO)


_SECTION = """case when criterion in ('bda_and_company_intro', 'purpose_of_call') then 'introduction' when criterion = 'qualification_questions' then 'qualification'
  when criterion in ('why_what_how_explanation', 'benefits_for_their_study') then 'product_and_pricing' when criterion = 'rebuttal_for_objections' then 'rebuttal'
  when criterion = 'two_way_conversation' then 'conversation' end"""


@query("ag_8_section_span", f"""
select pk, section, round(sum(metric_sum), 4) as section_sum, round(sum(metric_sum / metric_count), 4) as section_mean, count(*) as criteria from (
select pk, criterion, {_SECTION} as section, sum(coalesce(metric_sum, 0)) as metric_sum, sum(metric_count) as metric_count
from s_metrics where date_key between '{FROM}' and '{TO}' group by 1, 2, 3) c group by 1, 2
""")
def ag_8_sections(t: Inputs) -> DataFrame:
    return rollup.section_span(rollup.metric_totals(keyed_calls(t), t.marks), FROM, TO)


def _open_sql(name: str, bounds: str) -> str:
    return f"select '{name}' as range, pk, count(*) as days, sum(total_calls)::bigint as total_calls, sum(scored_calls)::bigint as scored_calls, round(round(sum(score_sum), 4) / nullif(sum(scored_calls), 0), 4) as score_mean from s_rollup where {bounds} group by pk"


@query("ag_8_open_spans", " union all ".join([_open_sql("since", f"date_key >= '{FROM}'"), _open_sql("until", f"date_key <= '{TO}'"), _open_sql("all", "true")]))
def ag_8_open(t: Inputs) -> DataFrame:
    """Ranges that are open at an end, or at both, of teams, agents and the floor."""
    days = day_rollup(t)
    spans = [rollup.span(days, start, end).select(F.lit(name).alias("range"), "pk", "days", "total_calls", "scored_calls", "score_mean")
             for name, start, end in (("since", f"{FROM}T00:00:00", None), ("until", None, TO), ("all", None, None))]
    return spans[0].unionByName(spans[1]).unionByName(spans[2])


@query("ag_9_section_marks", """
select call_id, case when criterion in ('bda_and_company_intro', 'purpose_of_call') then 'introduction' when criterion = 'qualification_questions' then 'qualification'
  when criterion in ('why_what_how_explanation', 'benefits_for_their_study') then 'product_and_pricing' when criterion = 'rebuttal_for_objections' then 'rebuttal'
  when criterion = 'two_way_conversation' then 'conversation' end as section, cast(sum(awarded) as bigint) as section_marks from v_marks group by 1, 2
""")
def ag_9(t: Inputs) -> DataFrame:
    return rollup.section_sums(t.marks, ["call_id"])


@query("ag_13_touched_days", "select distinct date_key from s_keyed_calls where processing_status = 'PROCESSED'")
def ag_13(t: Inputs) -> DataFrame:
    return bookkeeping.touched_days(t.calls.where("processing_status = 'PROCESSED'"))


@query("srt_4_ordered_rollup", "select pk, date_key, total_calls from s_rollup")
def srt_4(t: Inputs) -> DataFrame:
    return day_rollup(t).select("pk", "date_key", "total_calls").orderBy("date_key", "pk")


@query("srt_5_leaderboard", """
select pk, score_mean, scored_calls, rank() over (order by score_mean desc) as place from s_span where pk like 'AGENT#%' and score_mean is not null
""")
def srt_5(t: Inputs) -> DataFrame:
    spans = rollup.span(day_rollup(t), FROM, TO, scope="AGENT")
    return rollup.leaderboard(spans).select("pk", "score_mean", "scored_calls", F.col("rank").alias("place"))


# The stored roll-up stands for an earlier build: one that saw each discarded call as live and every
# agent under the team the plain extension gives.
step("s_stored", "select distinct strftime(started_at, '%Y-%m-%d') as date_key, concat('AGENT#UNASSIGNED#', agent_extension) as pk from v_calls union select date_key, pk from s_rollup")


def _stored(t: Inputs, fresh: DataFrame) -> DataFrame:
    old = t.calls.select(F.concat(F.lit("AGENT#UNASSIGNED#"), "agent_extension").alias("pk"), timing.date_key("started_at").alias("date_key"))
    return old.union(fresh.select("pk", "date_key")).distinct()


@query("jn_16_stale_rows", "select pk, date_key from s_stored except select pk, date_key from s_rollup")
def jn_16(t: Inputs) -> DataFrame:
    fresh = day_rollup(t)
    return storage.stale_rows(_stored(t, fresh), fresh)


@query("set_3_key_difference", "select pk, date_key from s_stored except select pk, date_key from s_rollup")
def set_3(t: Inputs) -> DataFrame:
    fresh = day_rollup(t).select("pk", "date_key")
    return _stored(t, fresh).exceptAll(fresh)


@query("snk_4_rebuild_counts", """
select date_key, cast(sum(w) as bigint) as rows_written, cast(sum(d) as bigint) as rows_deleted from (
  select date_key, 1 as w, 0 as d from s_rollup union all
  select date_key, 0, 1 from (select pk, date_key from s_stored except select pk, date_key from s_rollup) x) y group by 1
""")
def snk_4(t: Inputs) -> DataFrame:
    fresh = day_rollup(t)
    return storage.rebuild_counts(fresh, storage.stale_rows(_stored(t, fresh), fresh))


@query("snk_5_rebuild_days", f"""
select pk, date_key, {', '.join(NUMBERS)} from s_rollup where date_key in (select date_key from s_keyed_calls where disqualified)
""")
def snk_5(t: Inputs) -> DataFrame:
    days = bookkeeping.touched_days(t.calls.where("disqualified"))
    return rollup.rebuild_days(keyed_calls(t), days).select("pk", "date_key", *NUMBERS)
