"""Queries: call log, roster, work list, call rows and their keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.functions import paths, text, timing
from talkgrain.operators import agents, bookkeeping, calls, worklist
from talkgrain.sources import call_log, roster, storage

NOW = dt.datetime(1998, 6, 1, 0, 0, 0)
NOW_SQL = "timestamp '1998-06-01 00:00:00'"
ISO_SQL = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"


def _now():
    return F.lit(NOW).cast("timestamp")


# --- checks: shared steps ------------------------------------------------------
_DIGITS = "regexp_replace(coalesce({0}, ''), '[^0-9]', '', 'g')"


def ten_sql(column: str) -> str:
    digits = _DIGITS.format(column)
    return f"case when length({digits}) >= 10 then right({digits}, 10) else '' end"


step("s_log", f"""
select trim(callid) as callid, trim(unique_token) as unique_token, trim(call_direction) as call_direction, coalesce(trim(caller), '') as caller,
  coalesce(trim(caller_name), '') as caller_name, coalesce(trim(callee), '') as callee, coalesce(trim(callee_name), '') as callee_name,
  coalesce(trim(outbound_caller_id), '') as outbound_caller_id, coalesce(trim(did), '') as did, trim(start_date) as start_date,
  case when regexp_matches(trim(call_sec), '^[+-]?[0-9]+$') then cast(trim(call_sec) as bigint) else 0 end as call_sec,
  case when regexp_matches(trim(answer_sec), '^[+-]?[0-9]+$') then cast(trim(answer_sec) as bigint) else 0 end as answer_sec,
  trim(call_status) as call_status, trim(call_rec_path) as call_rec_path, start_ts, arrival
from v_log_raw
""")
step("s_sided", f"""
select *, case when inbound then callee else caller end as agent_extension,
  case when inbound then callee_name else caller_name end as agent_display_name,
  {ten_sql("case when inbound then caller else callee end")} as customer_phone,
  coalesce(nullif({ten_sql("case when inbound then did else outbound_caller_id end")}, ''),
           {ten_sql("case when inbound then outbound_caller_id else did end")}) as agent_did,
  case when lower(call_rec_path) not in ('', '-', 'n/a', 'na', 'null', 'none') and regexp_matches(lower(call_rec_path), '^https?://')
       then call_rec_path else '' end as recording_url,
  try_strptime(start_date, '%Y-%m-%d %H:%M:%S') - interval '330' minute as started_at
from (select *, upper(call_direction) = 'INBOUND' as inbound from s_log) x
""")
step("s_auditable", """
select *, (lower(call_status) = 'answered' and recording_url <> '' and call_sec > 0) as is_auditable from s_sided
""")
step("s_first", """
select * exclude (rn), count_all as deliveries
from (select *, row_number() over (partition by callid order by arrival) as rn, count(*) over (partition by callid) as count_all
      from s_auditable where callid <> '') x where rn = 1
""")
step("s_entries", "select pos, trim(extension) as extension, trim(name) as name, did, account_id, tl, state, "
                  "right(regexp_replace(did, '[^0-9]', '', 'g'), 10) as did_key from v_roster_file where trim(extension) <> ''")
step("s_roster", "select * exclude (rn) from (select *, row_number() over (partition by extension order by pos desc) as rn from s_entries) x where rn = 1")
step("s_keys", "select extension as key from s_roster union select account_id from s_entries")
step("s_by_account", "select * exclude (rn) from (select *, row_number() over (partition by account_id order by pos desc) as rn from s_entries) x where rn = 1")
step("s_by_did", "select did_key, max(extension) as extension, max(name) as name, max(tl) as tl, max(state) as state from s_entries group by did_key having count(*) = 1")


def resolved_sql(source: str) -> str:
    return f"""
select c.*, case when e.extension is not null then 'extension' when a.extension is not null then 'account'
    when d.extension is not null then 'did' else 'none' end as match_kind,
  coalesce(e.extension, a.extension, d.extension, c.agent_extension) as roster_extension,
  coalesce(e.name, a.name, d.name, concat('Unmapped extension ', case when c.agent_extension <> '' then c.agent_extension
    when c.agent_did <> '' then concat('DID ', c.agent_did) else '?' end)) as roster_name,
  coalesce(e.tl, a.tl, d.tl, '') as roster_tl, coalesce(e.state, a.state, d.state, '') as roster_team
from {source} c left join s_roster e on c.agent_extension = e.extension left join s_by_account a on c.agent_extension = a.account_id
  left join s_by_did d on right(regexp_replace(c.agent_did, '[^0-9]', '', 'g'), 10) = d.did_key
"""


step("s_piled", """
select f.*, case when k.callid is not null then 'already_known' when r.key is null then 'off_roster'
    when not f.is_auditable then 'skipped' else 'to_do' end as pile,
  case when k.callid is null and r.key is not null and not f.is_auditable then
    concat(case when f.call_status = '' then 'unknown status' else f.call_status end, case when f.recording_url = '' then ', no recording' else '' end) end as skip_reason
from s_first f left join v_known k on f.callid = k.callid left join s_keys r on f.agent_extension = r.key
""")


# --- queries -------------------------------------------------------------------
def sided(t: Inputs) -> DataFrame:
    return calls.with_sides(call_log.typed_call_log(t.log_raw))


def firsts(t: Inputs) -> DataFrame:
    return worklist.first_arrivals(sided(t))


def resolved_roster(t: Inputs) -> DataFrame:
    return roster.resolve_roster(t.roster_file)


def piled(t: Inputs) -> DataFrame:
    keys = agents.roster_keys(resolved_roster(t), t.roster_file)
    return worklist.dispositions(firsts(t), t.known, keys)


@query("src_1_call_log", "select callid, caller, caller_name, callee, outbound_caller_id, start_date, call_sec, answer_sec, call_status, arrival from s_log")
def src_1(t: Inputs) -> DataFrame:
    return call_log.typed_call_log(t.log_raw).select(
        "callid", "caller", "caller_name", "callee", "outbound_caller_id", "start_date", "call_sec", "answer_sec", "call_status", "arrival")


_BOUNDS = "(select date_trunc('hour', min(ts)) as lo, max(ts) + interval '5' hour as hi from events)"


@query("src_2_slices", f"""
select {ISO_SQL.format('s')} as slice_start, {ISO_SQL.format("least(s + interval '1' hour, hi)")} as slice_end, count(e.ts) as row_count
from (select unnest(generate_series(lo, hi - interval '1' microsecond, interval '1' hour)) as s, hi from {_BOUNDS} b) w
left join events e on e.ts >= s and e.ts < s + interval '1' hour group by s, hi
""")
def src_2(t: Inputs) -> DataFrame:
    row = t.events.agg(F.date_trunc("hour", F.min("ts")).alias("lo"), (F.max("ts") + F.expr("interval 5 hours")).alias("hi")).first()
    log = t.events.withColumn("start_ts", F.col("ts").cast("timestamp"))
    return call_log.slice_report(log, row["lo"], row["hi"]).select(
        timing.iso_utc("slice_start").alias("slice_start"), timing.iso_utc("slice_end").alias("slice_end"), "row_count")


@query("src_3_roster", "select extension, name, did, account_id, tl, state, did_key, (tl <> '') as audited from s_roster")
def src_3(t: Inputs) -> DataFrame:
    return resolved_roster(t).select("extension", "name", "did", "account_id", "tl", "state", "did_key", "audited")


@query("src_8_point_lookup", "select call_id, processing_status, duration_sec from v_calls where call_id in (select cast(doc_id as varchar) from labels)")
def src_8(t: Inputs) -> DataFrame:
    keys = t.labels.select(F.col("doc_id").cast("string").alias("call_id"))
    return calls.point_lookup(t.calls, keys).select("call_id", "processing_status", "duration_sec")


@query("src_8_existence", """
select call_id, call_id in (select call_id from v_calls) as is_stored from (select case when doc_id % 3 = 0 then 'no-' || doc_id else cast(doc_id as varchar) end as call_id from labels) x
""")
def src_8_existence(t: Inputs) -> DataFrame:
    """A third of the ids asked for is stored nowhere."""
    name = F.col("doc_id").cast("string")
    keys = t.labels.select(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("no-"), name)).otherwise(name).alias("call_id"))
    return calls.existing(t.calls, keys)


@query("src_8_token_window", """
select w.unique_token, min(l.callid) as callid, count(l.callid) as deliveries
from (select distinct unique_token, start_ts + case when length(callid) % 2 = 0 then interval '20' minute else interval '45' minute end as around from v_log_raw) w
left join v_log_raw l on w.unique_token = l.unique_token and l.start_ts between w.around - interval '30' minute and w.around + interval '30' minute group by w.unique_token
""")
def src_8_token(t: Inputs) -> DataFrame:
    """Half of the tokens are asked for too far from their time."""
    late = F.when(F.length("callid") % 2 == 0, F.expr("INTERVAL 20 MINUTES")).otherwise(F.expr("INTERVAL 45 MINUTES"))
    wanted = t.log_raw.select("unique_token", (F.col("start_ts") + late).alias("around"))
    return calls.by_token(t.log_raw, wanted).select("unique_token", "callid", "deliveries")


@query("prj_1_agent_side", "select callid, arrival, agent_extension, agent_display_name from s_sided")
def prj_1(t: Inputs) -> DataFrame:
    return sided(t).select("callid", "arrival", "agent_extension", "agent_display_name")


@query("prj_2_customer_phone", "select callid, arrival, customer_phone from s_sided")
def prj_2(t: Inputs) -> DataFrame:
    return sided(t).select("callid", "arrival", "customer_phone")


@query("prj_3_agent_did", "select callid, arrival, agent_did from s_sided")
def prj_3(t: Inputs) -> DataFrame:
    return sided(t).select("callid", "arrival", "agent_did")


@query("prj_4_recording_url", "select callid, arrival, recording_url from s_sided")
def prj_4(t: Inputs) -> DataFrame:
    return sided(t).select("callid", "arrival", "recording_url")


@query("prj_5_auditable", "select callid, arrival, call_sec from s_auditable where is_auditable")
def prj_5(t: Inputs) -> DataFrame:
    return sided(t).where("is_auditable").select("callid", "arrival", "call_sec")


step("s_log_resolved", resolved_sql("s_first"))


def log_resolved(t: Inputs) -> DataFrame:
    return agents.resolve_agents(firsts(t), resolved_roster(t), t.roster_file)


@query("prj_6_call_rows", f"""
select callid as call_id, customer_phone, coalesce({ISO_SQL.format('started_at')}, '') as started_at, call_sec as duration_sec,
  case when agent_extension <> '' then agent_extension else roster_extension end as agent_extension,
  case when match_kind <> 'none' then roster_name when agent_display_name <> '' then agent_display_name else roster_name end as agent_name,
  'INGESTING' as processing_status, call_direction from s_log_resolved
""")
def prj_6(t: Inputs) -> DataFrame:
    rows = calls.to_call_rows(log_resolved(t), "INGESTING", _now())
    return rows.select("call_id", "customer_phone", F.coalesce(timing.iso_utc("started_at"), F.lit("")).alias("started_at"), "duration_sec",
                       "agent_extension", "agent_name", "processing_status", "call_direction")


@query("prj_7_sparse_row", """
select call_id, processing_status, duration_sec, customer_phone, call_direction, nullif(agent_name, '') as agent_name, score, flag_count,
  audit_status, disqualified, failure_reason from v_calls
""")
def prj_7(t: Inputs) -> DataFrame:
    return calls.sparse(t.calls).drop("status_at")


_KEYED = f"""
select *, case when processing_status in ('INGESTING', 'UNPROCESSED', 'AUDITING', 'FAILED') then processing_status end as work_status,
  concat('AGENT#', agent_extension, '#', strftime(started_at, '%Y-%m')) as agent_month_key, concat('DAY#', strftime(started_at, '%Y-%m-%d')) as day_key,
  concat({ISO_SQL.format('started_at')}, '#', call_id) as time_ordinal, concat('CALL#', call_id) as pk from v_calls
"""
step("s_keyed", _KEYED)


@query("prj_8_keys", "select call_id, work_status, agent_month_key, day_key, time_ordinal, pk from s_keyed")
def prj_8(t: Inputs) -> DataFrame:
    return calls.with_keys(t.calls).select("call_id", "work_status", "agent_month_key", "day_key", "time_ordinal", "pk")


def band_sql(score: str) -> str:
    return (f"case when {score} is null then '' when {score} >= 85 then 'EXCELLENT' when {score} >= 75 then 'GOOD' "
            f"when {score} >= 60 then 'NEEDS_IMPROVEMENT' else 'POOR' end")


@query("prj_9_hydrate", f"""
select call_id, {ISO_SQL.format('started_at')} as started_at_iso, agent_extension, strftime(started_at, '%Y-%m-%d') as date_key,
  case when processing_status = 'DISCARDED' then '' else concat('audio/', strftime(started_at, '%Y/%m/%d'), '/', call_id, '.wav') end as audio_key,
  case when processing_status = 'PROCESSED' then concat('audit/', strftime(started_at, '%Y/%m/%d'), '/', call_id, '.json') else '' end as audit_key,
  case when score is not null or processing_status = 'PROCESSED' then {band_sql('score')} end as score_band from v_calls
""")
def prj_9(t: Inputs) -> DataFrame:
    items = calls.with_keys(t.calls).select("pk", "time_ordinal", "agent_month_key", "processing_status", "score")
    return calls.hydrate(items).select("call_id", "started_at_iso", "agent_extension", "date_key", "audio_key", "audit_key", "score_band")


@query("prj_12_tombstone", """
select call_id, case when disqualified then 'DISCARDED' else processing_status end as processing_status, case when not disqualified then score end as score,
  case when not disqualified then flag_count end as flag_count, case when not disqualified then audit_status end as audit_status,
  case when not disqualified then agent_name end as agent_name, case when not disqualified then customer_phone end as customer_phone,
  case when not disqualified then agent_month_key end as agent_month_key, case when not disqualified then day_key end as day_key from s_keyed
""")
def prj_12(t: Inputs) -> DataFrame:
    gone = calls.discard(calls.with_keys(t.calls), F.col("disqualified"))
    return gone.select("call_id", "processing_status", "score", "flag_count", "audit_status", "agent_name", "customer_phone", "agent_month_key", "day_key")


@query("prj_19_review", "select call_id, (coalesce(flag_count, 0) > 0 and not coalesce(disqualified, false)) as is_review from v_calls")
def prj_19(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", calls.is_review().alias("is_review"))


@query("prj_20_disposition", "select callid, pile, skip_reason from s_piled")
def prj_20(t: Inputs) -> DataFrame:
    return piled(t).select("callid", "pile", "skip_reason")


_STALLED = f"""
select *, (processing_status = 'INGESTING' and started_at <= {NOW_SQL} - interval '60' minute
  and not coalesce(coalesce(status_at, started_at) > {NOW_SQL} - interval '60' minute, false)) as stalled from v_calls
"""


@query("prj_22_stalled", f"""
select call_id, case when stalled then 'FAILED' else processing_status end as processing_status,
  case when stalled then 'the download never finished' end as failure_reason, stalled from ({_STALLED}) x
""")
def prj_22(t: Inputs) -> DataFrame:
    return calls.fail_stalled(t.calls, _now()).select("call_id", "processing_status", "failure_reason", "stalled")


@query("prj_23_revive", """
select call_id, case when processing_status = 'AUDITING' then 'UNPROCESSED' else processing_status end as processing_status,
  (processing_status = 'AUDITING') as revived from v_calls
""")
def prj_23(t: Inputs) -> DataFrame:
    return calls.revive_legacy(t.calls, _now()).select("call_id", "processing_status", "revived")


_CHANGES = """
select concat(trim(callid), '') as call_id, arrival, case when call_direction = 'Inbound' then 'UNPROCESSED' end as expected_status, 'AUDITING' as new_status
from v_log_raw
"""


# At most two changes a call: the second is judged by what the first has left.
@query("prj_24_guarded_update", f"""
select * from (with ch as (select x.*, c.processing_status as stored from ({_CHANGES}) x left join v_calls c on x.call_id = c.call_id),
one as (select *, coalesce(stored is not null and (expected_status is null or expected_status = stored), false) as applied from ch where arrival = 0),
left_by as (select call_id, any_value(case when applied then new_status else stored end) as now from one where stored is not null group by 1),
two as (select ch.*, coalesce(left_by.now, stored) as before from ch left join left_by on ch.call_id = left_by.call_id where arrival = 1)
select call_id, arrival, applied, case when applied then new_status else stored end as status_after from one
union all select call_id, arrival, coalesce(before is not null and (expected_status is null or expected_status = before), false),
  case when coalesce(before is not null and (expected_status is null or expected_status = before), false) then new_status else before end from two) z
""")
def prj_24(t: Inputs) -> DataFrame:
    changes = t.log_raw.select(
        F.trim("callid").alias("call_id"), "arrival",
        F.when(F.col("call_direction") == "Inbound", "UNPROCESSED").alias("expected_status"), F.lit("AUDITING").alias("new_status"))
    return calls.apply_status_changes(t.calls, changes, ("arrival",)).select("call_id", "arrival", "applied", "status_after")


_JOBS = """
select concat('', cast(event_id as varchar(20))) as call_id, (event_type <> 'signup') as audio_present,
  case event_type when 'error' then 'stage' when 'view' then 'ValueError' end as error_kind, concat('broke: ', props) as error from events
"""


@query("prj_25_audit_outcome", f"""
select j.call_id, case when c.call_id is null then 'skipped' when processing_status in ('PROCESSED', 'DISCARDED') then 'skipped'
    when not audio_present then 'failed' when error_kind = 'stage' then 'retry' when error_kind is not null then 'failed' else 'audited' end as outcome,
  case when c.call_id is null then 'no row' when processing_status in ('PROCESSED', 'DISCARDED') then concat('already ', processing_status)
    when not audio_present then concat('audio missing at audio/', strftime(started_at, '%Y/%m/%d'), '/', j.call_id, '.wav')
    when error_kind = 'stage' then left(concat('pipeline: ', error), 400) when error_kind is not null then left(concat(error_kind, ': ', error), 400)
    else strftime(started_at, '%Y-%m-%d') end as detail,
  case when c.call_id is null or processing_status in ('PROCESSED', 'DISCARDED') then processing_status when not audio_present then 'FAILED'
    when error_kind = 'stage' then 'UNPROCESSED' when error_kind is not null then 'FAILED' else 'PROCESSED' end as status_after
from ({_JOBS}) j left join v_calls c on j.call_id = c.call_id
""")
def prj_25(t: Inputs) -> DataFrame:
    return calls.audit_disposition(jobs(t), t.calls).select("call_id", "outcome", "detail", "status_after")


def jobs(t: Inputs) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "stage").when(F.col("event_type") == "view", "ValueError")
    return t.events.select(F.col("event_id").cast("string").alias("call_id"), (F.col("event_type") != "signup").alias("audio_present"),
                           kind.alias("error_kind"), F.concat(F.lit("broke: "), "props").alias("error"))


@query("jn_1_unknown_ids", "select callid, deliveries from s_first where callid not in (select callid from v_known)")
def jn_1(t: Inputs) -> DataFrame:
    return firsts(t).join(t.known, "callid", "left_anti").select("callid", "deliveries")


@query("jn_2_on_roster", "select call_id, agent_extension from v_calls where agent_extension in (select key from s_keys)")
def jn_2(t: Inputs) -> DataFrame:
    return agents.on_roster(t.calls, agents.roster_keys(resolved_roster(t), t.roster_file)).select("call_id", "agent_extension")


step("s_calls_resolved", resolved_sql("v_calls"))


@query("jn_3_resolve_agent", "select call_id, match_kind, roster_extension, roster_name, roster_tl, roster_team from s_calls_resolved")
def jn_3(t: Inputs) -> DataFrame:
    found = agents.resolve_agents(t.calls, resolved_roster(t), t.roster_file)
    return found.select("call_id", "match_kind", "roster_extension", "roster_name", "roster_tl", "roster_team")


@query("jn_4_unique_dids", "select did_key, extension from s_by_did")
def jn_4(t: Inputs) -> DataFrame:
    return agents.did_index(t.roster_file).select("did_key", "agent.extension")


@query("jn_15_batch_selection", """
select call_id, level, coalesce(parent_id, call_id) as sort_id from (
  select concat(call_id, case when call_direction = 'INBOUND' then '_follow_up' else '' end) as call_id, case when call_direction = 'INBOUND' then 1 else 0 end as level,
    case when call_direction = 'INBOUND' then call_id end as parent_id from v_calls) x
where call_id not in (select call_id from v_calls where processing_status = 'PROCESSED')
""")
def jn_15(t: Inputs) -> DataFrame:
    name = F.concat("call_id", F.when(F.col("call_direction") == "INBOUND", K.FOLLOW_UP_SUFFIX).otherwise(""))
    done = t.calls.where("processing_status = 'PROCESSED'")
    return worklist.audit_batch(t.calls.select(name.alias("call_id")), done).select("call_id", "level", "sort_id")


@query("ag_10_outstanding", """
select processing_status, count(*) as call_count from v_calls where processing_status in ('INGESTING', 'UNPROCESSED', 'AUDITING', 'FAILED') group by 1
""")
def ag_10(t: Inputs) -> DataFrame:
    return calls.outstanding_counts(t.calls)


@query("ag_11_collection_counts", """
select count(*) as fetched, cast(sum(deliveries - 1) as bigint) as duplicates, count_if(pile = 'already_known') as already_known, count_if(pile = 'off_roster') as off_roster,
  count_if(pile = 'skipped') as skipped, count_if(pile = 'to_do') as to_do, cast(0 as bigint) as failed_slices from s_piled
""")
def ag_11(t: Inputs) -> DataFrame:
    return worklist.collection_counts(piled(t))


@query("ag_25_off_roster_top", """
select case when agent_extension = '' then '?' else agent_extension end as extension, count(*) as call_count from s_piled where pile = 'off_roster'
group by 1 order by call_count desc, extension limit 15
""")
def ag_25(t: Inputs) -> DataFrame:
    return worklist.top_off_roster(piled(t))


@query("ag_25_skip_reasons", "select skip_reason, count(*) as call_count from s_piled where pile = 'skipped' group by 1")
def ag_25_reasons(t: Inputs) -> DataFrame:
    return worklist.skip_reasons(piled(t))


@query("ag_26_teams", "select tl, extension, name from s_roster where tl <> ''")
def ag_26(t: Inputs) -> DataFrame:
    return agents.teams(resolved_roster(t))


@query("ag_27_unmapped", "select distinct case when agent_extension = '' then '?' else agent_extension end as extension from s_calls_resolved where match_kind = 'none'")
def ag_27(t: Inputs) -> DataFrame:
    return agents.unmapped_extensions(agents.resolve_agents(t.calls, resolved_roster(t), t.roster_file))


@query("win_9_first_arrivals", "select callid, arrival, deliveries, call_status from s_first")
def win_9(t: Inputs) -> DataFrame:
    return firsts(t).select("callid", "arrival", "deliveries", "call_status")


@query("srt_1_capped_work_list", f"select callid, {ISO_SQL.format('started_at')} as started_at from s_piled where pile = 'to_do' order by s_piled.started_at nulls first, callid limit 100")
def srt_1(t: Inputs) -> DataFrame:
    return worklist.capped(piled(t), 100).select("callid", timing.iso_utc("started_at").alias("started_at"))


@query("srt_2_pending", f"select call_id, {ISO_SQL.format('v_calls.started_at')} as started_at from v_calls where processing_status = 'UNPROCESSED' order by v_calls.started_at, call_id limit 250")
def srt_2(t: Inputs) -> DataFrame:
    return calls.pending(t.calls, 250).select("call_id", timing.iso_utc("started_at").alias("started_at"))


@query("srt_3_newest_calls", f"""
select call_id, {ISO_SQL.format('v_calls.started_at')} as started_at, processing_status from v_calls
where processing_status = 'FAILED' and v_calls.started_at >= timestamp '1996-01-01' and v_calls.started_at <= timestamp '2000-01-01'
order by v_calls.started_at desc, call_id limit 50
""")
def srt_3(t: Inputs) -> DataFrame:
    moment = lambda s: F.to_timestamp_ntz(F.lit(s))
    page = calls.list_calls(t.calls, status="FAILED", start=moment("1996-01-01 00:00:00"), end=moment("2000-01-01 00:00:00"), limit=50)
    return page.select("call_id", timing.iso_utc("started_at").alias("started_at"), "processing_status")


@query("set_1_bag_union", "select callid, arrival, count(*) as copies from s_log group by 1, 2")
def set_1(t: Inputs) -> DataFrame:
    log = call_log.typed_call_log(t.log_raw)
    first, again = log.where("arrival = 0"), log.where("arrival = 1")
    return first.unionByName(again).groupBy("callid", "arrival").agg(F.count("*").alias("copies"))


@query("set_2_buckets", """
select call_id, strftime(d, '%Y-%m-%d') as day_bucket, strftime(d, '%Y-%m') as month_bucket
from (select call_id, unnest(generate_series(cast(started_at as date), cast(started_at as date) + 2, interval '1' day)) as d from v_calls) x
""")
def set_2(t: Inputs) -> DataFrame:
    last = F.date_add(F.to_date("started_at"), 2)
    days = t.calls.select("call_id", F.explode(timing.days_newest_first("started_at", last)).alias("d"))
    return days.select("call_id", timing.date_key("d").alias("day_bucket"), timing.month_key("d").alias("month_bucket"))


@query("set_2_months", """
select call_id, strftime(d, '%Y-%m') as month_bucket
from (select call_id, unnest(generate_series(date_trunc('month', started_at), started_at + interval '45' day, interval '1' month)) as d from v_calls) x
""")
def set_2_months(t: Inputs) -> DataFrame:
    end = F.col("started_at") + F.expr("interval 45 days")
    return t.calls.select("call_id", F.explode(timing.months_oldest_first("started_at", end)).alias("month_bucket"))


@query("dq_8_suspicious_slices", f"""
select {ISO_SQL.format("date_trunc('hour', start_ts)")} as slice_start, count(*) as row_count from v_log_raw group by 1 having count(*) >= 15
""")
def dq_8(t: Inputs) -> DataFrame:
    log = t.log_raw.withColumn("start_ts", F.col("start_ts").cast("timestamp"))
    return call_log.suspicious_slices(log, rows=15).select(timing.iso_utc("slice_start").alias("slice_start"), "row_count")


# --- time ----------------------------------------------------------------------
@query("dt_1_local_to_utc", f"select callid, arrival, coalesce({ISO_SQL.format('started_at')}, '') as started_iso from s_sided")
def dt_1(t: Inputs) -> DataFrame:
    log = call_log.typed_call_log(t.log_raw)
    return log.select("callid", "arrival", timing.local_to_iso("start_date").alias("started_iso"))


@query("dt_2_utc_to_local", f"""
select call_id, strftime(started_at + interval '330' minute, '%Y-%m-%d %H:%M:%S') as local_time, {ISO_SQL.format('started_at')} as iso_time,
  (status_at is not null) as parsed from v_calls
""")
def dt_2(t: Inputs) -> DataFrame:
    parsed = timing.parse_iso(F.coalesce(timing.iso_utc("status_at"), F.lit("not a time")))
    return t.calls.select("call_id", F.date_format(timing.utc_to_local("started_at"), K.LOG_TIME_FORMAT).alias("local_time"),
                          timing.iso_utc("started_at").alias("iso_time"), parsed.isNotNull().alias("parsed"))


@query("dt_3_business_day", f"""
select call_id, strftime(local - interval '2' hour, '%Y-%m-%d') as business_day,
  {ISO_SQL.format("e - interval '1' day - interval '330' minute")} as last_day_start, {ISO_SQL.format("e - interval '330' minute")} as last_day_end
from (select call_id, local, case when cut > local + interval '15' minute then cut - interval '1' day else cut end as e
      from (select call_id, local, date_trunc('day', local) + interval '2' hour as cut
            from (select call_id, started_at + interval '330' minute as local from v_calls) a) b) c
""")
def dt_3(t: Inputs) -> DataFrame:
    start, end = timing.last_complete_day("started_at")
    return t.calls.select("call_id", timing.business_day("started_at").alias("business_day"), timing.iso_utc(start).alias("last_day_start"),
                          timing.iso_utc(end).alias("last_day_end"))


@query("dt_4_window_hours", """
select call_id, (started_at >= status_at) as is_empty, round(date_diff('second', started_at, status_at) / 3600.0e0, 4) as hours from v_calls where status_at is not null
""")
def dt_4(t: Inputs) -> DataFrame:
    seconds = F.unix_timestamp(F.col("status_at").cast("timestamp")) - F.unix_timestamp(F.col("started_at").cast("timestamp"))
    return t.calls.where("status_at is not null").select(
        "call_id", (F.col("started_at") >= F.col("status_at")).alias("is_empty"), F.round(seconds / 3600.0, 4).alias("hours"))


@query("dt_5_window_slices", f"""
select call_id, {ISO_SQL.format('s')} as slice_start, {ISO_SQL.format("least(s + interval '60' minute, hi)")} as slice_end
from (select call_id, unnest(generate_series(lo, hi - interval '1' microsecond, interval '60' minute)) as s, hi
      from (select call_id, started_at as lo, started_at + interval '1' second * cast(duration_sec * 10 as int) as hi from v_calls) a where lo < hi) x
""")
def dt_5(t: Inputs) -> DataFrame:
    windows = t.calls.select("call_id", F.col("started_at").alias("window_start"),
                             F.expr("started_at + interval '1' second * cast(duration_sec * 10 as int)").alias("window_end"))
    return timing.slices(windows).select("call_id", timing.iso_utc("slice_start").alias("slice_start"), timing.iso_utc("slice_end").alias("slice_end"))


@query("dt_6_day_keys", "select call_id, strftime(started_at, '%Y-%m-%d') as date_key, strftime(started_at, '%Y/%m/%d') as date_path, strftime(started_at, '%Y-%m') as month_key from v_calls")
def dt_6(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", timing.date_key("started_at").alias("date_key"), timing.date_path("started_at").alias("date_path"),
                          timing.month_key("started_at").alias("month_key"))


@query("dt_7_text_bounds", f"""
select call_id, concat(strftime(started_at, '%Y-%m-%d'), 'T') as low, concat(strftime(started_at, '%Y-%m-%d'), 'T23:59:59Z') as high from v_calls
""")
def dt_7(t: Inputs) -> DataFrame:
    low, high = timing.day_text_bounds(timing.date_key("started_at"))
    return t.calls.select("call_id", low.alias("low"), high.alias("high"))


@query("dt_8_expiry", "select call_id, cast(epoch(started_at) as bigint) + 7776000 as expires_at from v_calls")
def dt_8(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", timing.expiry_epoch(F.col("started_at").cast("timestamp")).alias("expires_at"))


# --- names and keys ------------------------------------------------------------
@query("str_1_ten_digits", f"select callid, arrival, {ten_sql('caller')} as caller_digits, {ten_sql('callee')} as callee_digits from v_log_raw")
def str_1(t: Inputs) -> DataFrame:
    return t.log_raw.select("callid", "arrival", text.ten_digits("caller").alias("caller_digits"), text.ten_digits("callee").alias("callee_digits"))


@query("str_2_did_key", f"select callid, arrival, right({_DIGITS.format('did')}, 10) as did_key from v_log_raw")
def str_2(t: Inputs) -> DataFrame:
    return t.log_raw.select("callid", "arrival", text.did_key("did").alias("did_key"))


@query("str_3_slug", r"""
select page_id, coalesce(nullif(trim(lower(regexp_replace(regexp_replace(translate(strip_accents(title), 'ßæœøđłþð', ''), '[^\x00-\x7F]', '', 'g'), '[^a-zA-Z0-9]+', '-', 'g')), '-'), ''), 'unknown') as slug
from (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages) x
""")
def str_3(t: Inputs) -> DataFrame:
    return t.pages.select("page_id", text.slug(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("slug"))


@query("src_6_manifest", r"""
select page_id, (split_part(key, '/', 1) = 'audio' and lower(ext) in ('.wav', '.mp3', '.m4a', '.mp4', '.ogg', '.flac', '.aac', '.amr', '.webm')) as is_recording,
  left(base, length(base) - length(ext)) as call_id
from (select page_id, key, base, regexp_extract(base, '^\.*[^.].*(\.[^.]*)$', 1) as ext
      from (select page_id, key, regexp_extract(key, '[^/]*$') as base
            from (select page_id, concat(case when length(html) % 3 = 0 then 'report/' else 'audio/' end, '2026/01/02/', cast(page_id as varchar), '.', regexp_extract(url, '[^/]*$'),
                    case length(html) % 4 when 0 then '.WAV' when 1 then '.mp3' when 2 then '.json' else '' end) as key from pages) a) b) c
""")
def src_6(t: Inputs) -> DataFrame:
    folder = F.when(F.length("html") % 3 == 0, "report/").otherwise("audio/")
    n = F.length("html") % 4
    suffix = F.when(n == 0, ".WAV").when(n == 1, ".mp3").when(n == 2, ".json").otherwise("")
    key = F.concat(folder, F.lit("2026/01/02/"), F.col("page_id").cast("string"), F.lit("."), paths.base_name("url"), suffix)
    keyed = t.pages.select("page_id", key.alias("key"))
    return keyed.select("page_id", paths.is_recording("key").alias("is_recording"), paths.call_id_of_key("key").alias("call_id"))


_FILE_SUFFIX = ("case o_orderkey % 6 when 0 then '.clean.json' when 1 then '.analysis.json' when 2 then '.transcript.json' "
                "when 3 then '.audit.json' when 4 then '.json' else '.txt' end")


@query("src_7_file_ids", f"""
select o_orderkey, cast(o_orderkey as varchar) as call_id, case when o_orderkey % 6 = 5 then cast(o_orderkey as varchar) else cast(o_orderkey as varchar) end as stem from orders
""")
def src_7(t: Inputs) -> DataFrame:
    path = F.expr(f"concat('/in/', cast(o_custkey as string), '/', cast(o_orderkey as string), {_FILE_SUFFIX})")
    named = t.orders.select("o_orderkey", path.alias("path"))
    return named.select("o_orderkey", paths.call_id_of_file("path").alias("call_id"), paths.call_stem("path").alias("stem"))


@query("prj_26_follow_up_ids", """
select call_id, (suffix <> '') as is_follow_up, case when suffix <> '' then base end as parent_id
from (select call_id as base, case when call_direction = 'INBOUND' then '_follow_up' else '' end as suffix,
        concat(call_id, case when call_direction = 'INBOUND' then '_follow_up' else '' end) as call_id from v_calls) x
""")
def prj_26(t: Inputs) -> DataFrame:
    name = F.concat("call_id", F.when(F.col("call_direction") == "INBOUND", K.FOLLOW_UP_SUFFIX).otherwise(""))
    named = t.calls.select(name.alias("call_id"))
    return named.select("call_id", paths.is_follow_up("call_id").alias("is_follow_up"), paths.parent_call_id("call_id").alias("parent_id"))


_KINDS = "(values ('audio', '.wav'), ('transcript', '.json'), ('clean', '.json'), ('analysis', '.json'), ('audit', '.json'), ('report', '.pdf')) k(kind, ext)"


@query("snk_1_artifact_keys", f"""
select call_id, kind, strftime(started_at, '%Y') as yyyy, strftime(started_at, '%m') as mm, strftime(started_at, '%d') as dd,
  concat(kind, '/', strftime(started_at, '%Y/%m/%d'), '/', call_id, ext) as key from v_calls, {_KINDS} where kind in ('transcript', 'clean', 'analysis', 'audit')
""")
def snk_1(t: Inputs) -> DataFrame:
    owned = storage.with_day_parts(t.calls.select("call_id", "started_at", F.explode(paths.every_key("call_id", "started_at")).alias("o")))
    return owned.select("call_id", "o.kind", "yyyy", "mm", "dd", "o.key").where(F.col("kind").isin(list(K.ARTIFACT_KINDS)))


@query("snk_2_owned_keys", f"select call_id, kind, concat(kind, '/', strftime(started_at, '%Y/%m/%d'), '/', call_id, ext) as key from v_calls, {_KINDS}")
def snk_2(t: Inputs) -> DataFrame:
    return storage.owned_keys(t.calls)


@query("snk_3_insert_if_absent", "select callid, (callid not in (select callid from v_known)) as accepted from s_first")
def snk_3(t: Inputs) -> DataFrame:
    return storage.split_by_presence(firsts(t).select("callid"), t.known, "callid")


@query("snk_6_published_roster", "select extension, name, did_key as did, account_id, state as team, tl as team_leader_name, (tl <> '') as audited from s_roster")
def snk_6(t: Inputs) -> DataFrame:
    return roster.published_roster(resolved_roster(t))


@query("snk_9_session_state", """
select session_id, case when bool_or(event_type <> 'error') then 'COMPLETED' else 'PENDING' end as status from (select user_id as session_id, event_type from events) x group by 1
""")
def snk_9(t: Inputs) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "PENDING").otherwise("COMPLETED")
    rows = t.events.select(F.col("user_id").alias("session_id"), status.alias("status"), "ts")
    return bookkeeping.session_state(rows).select("session_id", "status")


@query("set_5_distinct_days", "select distinct strftime(started_at, '%Y-%m-%d') as date_key from v_calls")
def set_5(t: Inputs) -> DataFrame:
    return bookkeeping.touched_days(t.calls)
