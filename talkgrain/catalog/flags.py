"""Queries: conduct flags, objections, citations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.catalog.conversation import turns
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.functions import marks, text
from talkgrain.operators import bookkeeping, flags, quality

_BIG = 1_000_000


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def type_sql(column: str) -> str:
    exact = " ".join(f"when {column} = '{c}' then '{k}'" for c, k in K.FLAG_TYPE_BY_CATEGORY.items())
    words = " ".join(f"when contains({column}, '{w}') then '{k}'" for w, k in K.FLAG_TYPE_BY_KEYWORD)
    return f"case {exact} {words} else '{K.DEFAULT_FLAG_TYPE}' end"


def upstream(t: Inputs) -> DataFrame:
    also = F.when(F.col("also_at").isNotNull(), F.array("also_at")).otherwise(F.array().cast("array<bigint>"))
    return t.upstream.withColumn("also_at_turns", also).drop("also_at")


def report_flags(t: Inputs) -> DataFrame:
    listed = F.when(F.col("also_at").isNotNull(), F.array("turn_index", "also_at")).otherwise(F.array("turn_index"))
    return t.report_flags.withColumn("occurrence_turns", listed).drop("also_at")


def objections(t: Inputs) -> DataFrame:
    again = F.when(F.col("repeated_at").isNotNull(), F.array("repeated_at")).otherwise(F.array().cast("array<bigint>"))
    return t.objections.withColumn("repeated_at_turns", again).drop("repeated_at")


def _text(column: str):
    return F.array_join(F.transform(column, lambda v: v.cast("string")), ",").alias(column)


@query("prj_27_flag_types", f"""
select call_id, seq, {type_sql('c')} as flag_type, c not in ({_quoted(K.NON_CONDUCT_CATEGORIES)}) as is_conduct
from (select *, lower(trim(category)) as c from v_upstream) x
""")
def prj_27(t: Inputs) -> DataFrame:
    category = F.lower(F.trim("category"))
    return t.upstream.select("call_id", "seq", flags.flag_type(category).alias("flag_type"), flags.is_conduct(category).alias("is_conduct"))


@query("prj_29_verdict_flags", """
select v.call_id, v.turn + 1 as turn, s.speaker, trim(case when v.phrase = '' then s.text else v.phrase end) as phrase,
  case when v.category = '' then 'other' else v.category end as category, coalesce(v.severity, 'medium') as severity, coalesce(v.reason, '') as reason, 'conduct_scan' as source
from v_verdicts v join s_turns s on v.call_id = s.call_id and v.turn = s.turn where v.flagged
""")
def prj_29(t: Inputs) -> DataFrame:
    return flags.flags_from_verdicts(t.verdicts, turns(t))


def located_sql(source: str) -> str:
    near = f"case when t.turn = f.stated then 0 when t.turn = f.stated - 1 then 1 when t.turn = f.stated + 1 then 2 else 3 end * {_BIG} + t.turn"
    return f"""
select f.call_id, f.seq, min_by(t.turn, {near}) as found_turn from {source} f
left join s_turns t on f.call_id = t.call_id and f.needle <> '' and (f.said = '' or lower(t.speaker) = f.said) and contains(t.text, f.needle) group by 1, 2
"""


step("s_asked", r"select call_id, seq, stated, lower(trim(speaker)) as said, trim(regexp_replace(phrase, '\s+', ' ', 'g')) as needle from v_upstream")
step("s_located", located_sql("s_asked"))


@query("jn_8_locate_phrases", "select call_id, seq, found_turn from s_located")
def jn_8(t: Inputs) -> DataFrame:
    return flags.locate_phrases(t.upstream, turns(t)).select("call_id", "seq", "found_turn")


step("s_quoted", r"select call_id, seq, turn_index as stated, 'employee' as said, trim(regexp_replace(verbatim, '\s+', ' ', 'g')) as needle from v_report_flags")
step("s_quotes_found", located_sql("s_quoted"))
step("s_reanchored", """
select r.call_id, r.seq, r.flag_type, r.severity, r.verbatim, r.occurrences, r.source, r.why_flagged, coalesce(q.found_turn is not null and q.found_turn <> r.turn_index, false) as moved,
  case when q.found_turn is not null and q.found_turn <> r.turn_index then q.found_turn else r.turn_index end as turn_index,
  case when q.found_turn is not null and q.found_turn <> r.turn_index
    then list_sort(list_distinct(list_concat([q.found_turn], list_filter([r.turn_index, r.also_at], lambda x: x is not null and x <> r.turn_index))))
    else list_filter([r.turn_index, r.also_at], lambda x: x is not null) end as occurrence_turns
from v_report_flags r join s_quotes_found q on r.call_id = q.call_id and r.seq = q.seq
""")


@query("jn_9_reanchored_flags", "select call_id, seq, moved, turn_index, array_to_string(occurrence_turns, ',') as occurrence_turns from s_reanchored")
def jn_9(t: Inputs) -> DataFrame:
    return flags.reanchor(report_flags(t), turns(t)).select("call_id", "seq", "moved", "turn_index", _text("occurrence_turns"))


# The check takes one upstream flag of a call after the other and keeps what is covered.
step("s_sizes", "select call_id, count(*) as n from s_turns group by 1")
step("s_dismissed", "select call_id, list(turn) as thrown from v_dismissed group by 1")
JUDGED = f"""
select u.call_id, u.seq, u.stated, row_number() over (partition by u.call_id order by u.seq) as i, lower(trim(u.category)) as category,
  case when lower(trim(severity)) in ('low', 'medium', 'high') then lower(trim(severity)) else 'medium' end as severity, l.found_turn is not null as anchored,
  coalesce(l.found_turn, case when u.stated >= 0 and u.stated < z.n then u.stated else 0 end) as turn, u.also_at, z.n,
  coalesce(c.covered, []) as covered0, list_filter(coalesce(d.thrown, []), lambda x: not list_contains(coalesce(c.covered, []), x)) as thrown
from v_upstream u join s_located l on u.call_id = l.call_id and u.seq = l.seq join s_sizes z on u.call_id = z.call_id
  left join s_covered c on u.call_id = c.call_id left join s_dismissed d on u.call_id = d.call_id
"""
JUDGED_2 = """
select *, list_sort(list_distinct(list_concat([turn], case when also_at is not null and also_at + coalesce(turn - stated, 0) >= 0 and also_at + coalesce(turn - stated, 0) < n
    then [also_at + coalesce(turn - stated, 0)] else [] end))) as occ,
  (list_contains(thrown, turn) or coalesce(list_contains(thrown, stated), false)) as gone, category in ('misleading_claim', 'false_claim', 'false_promise', 'overpromise', 'exaggeration',
  'unrealistic_promise', 'product_claim', 'misrepresentation') as product from s_judged
"""
CARRY = """
select * from (with recursive walk as (
  select call_id, cast(0 as bigint) as i, any_value(covered0) as covered, cast(null as bigint) as seq, cast('' as varchar) as fate from s_judged2 group by call_id
  union all
  select j.call_id, j.i, case when list_contains(w.covered, j.turn) or j.gone or j.product then w.covered else list_concat(w.covered, j.occ) end, j.seq,
    case when list_contains(w.covered, j.turn) then 'covered' when j.gone then 'dismissed' when j.product then 'not_conduct' else 'carried' end
  from walk w join s_judged2 j on j.call_id = w.call_id and j.i = w.i + 1)
select * from walk where seq is not null) z
"""


def carry_steps(p: str, covered: str) -> None:
    """Steps of the carry-over, by the turns that some report flags cover."""
    step(f"s_{p}covered", f"select call_id, list_distinct(flatten(list({covered}))) as covered from {'s_reanchored' if p else 'v_report_flags'} group by 1")
    step(f"s_{p}judged", JUDGED.replace("s_covered", f"s_{p}covered"))
    step(f"s_{p}judged2", JUDGED_2.replace("s_judged", f"s_{p}judged"))
    step(f"s_{p}carry", CARRY.replace("s_judged2", f"s_{p}judged2"))


carry_steps("", "list_filter([turn_index, also_at], lambda x: x is not null)")
carry_steps("chain_", "list_append(occurrence_turns, turn_index)")


def carried(t: Inputs) -> DataFrame:
    return flags.carry_over(report_flags(t), upstream(t), turns(t), t.dismissed)


@query("jn_10_carry_over", f"""
select j.call_id, j.seq, j.turn, j.anchored, c.fate, j.severity, {type_sql('j.category')} as flag_type, array_to_string(j.occ, ',') as occurrence_turns
from s_judged2 j join s_carry c on j.call_id = c.call_id and j.seq = c.seq
""")
def jn_10(t: Inputs) -> DataFrame:
    return carried(t).select("call_id", "seq", "turn", "anchored", "fate", "severity", "flag_type", _text("occurrence_turns"))


_SPLIT = r"[\s।॥,.?!;:\"''()–—-]+"
_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '" + _SPLIT + "'), lambda w: length(w) > 2))"


@query("jn_11_unlinked_repeats", f"""
select o.call_id, o.objection_id, o.turn_index, s.turn, round(len(list_intersect(o.a, s.b)) / cast(least(len(o.a), len(s.b)) as double), 4) as overlap
from (select *, {_TOKENS.format('verbatim')} as a from v_objections) o join (select *, {_TOKENS.format('text')} as b from s_turns where speaker = 'Customer') s on o.call_id = s.call_id
where s.turn <= o.turn_index and s.turn <> o.turn_index and s.turn is distinct from o.repeated_at and len(o.a) > 0 and len(s.b) > 0
  and len(list_intersect(o.a, s.b)) / cast(least(len(o.a), len(s.b)) as double) >= 0.1
""")
def jn_11(t: Inputs) -> DataFrame:
    """A tenth of the tokens is enough here: made-up words are seldom said twice."""
    return flags.unlinked_repeats(objections(t), turns(t), share=0.1)


# --- merging ------------------------------------------------------------------------
def _merge_sql(source: str, name: str) -> None:
    """Steps of the merge of neighbouring flags: one flag after the other in turn order."""
    rank = "coalesce(case severity when 'low' then 0 when 'medium' then 1 when 'high' then 2 end, 1)"
    step(f"s_{name}_ordered", f"select *, {rank} as rk, row_number() over (partition by call_id order by turn, seq) as i from {source}")
    step(f"s_{name}_walk", f"""
select * from (with recursive walk as (
  select call_id, i, turn as anchor, category as kind, i as finding from s_{name}_ordered where i = 1
  union all
  select o.call_id, o.i, case when o.category is not distinct from w.kind and o.turn - w.anchor <= {K.MERGE_GAP_TURNS} then w.anchor else o.turn end, o.category,
    case when o.category is not distinct from w.kind and o.turn - w.anchor <= {K.MERGE_GAP_TURNS} then w.finding else o.i end
  from walk w join s_{name}_ordered o on o.call_id = w.call_id and o.i = w.i + 1)
select * from walk) z
""")
    step(f"s_{name}_flags", f"select o.*, w.anchor, w.finding from s_{name}_ordered o join s_{name}_walk w on o.call_id = w.call_id and o.i = w.i")
    step(f"s_{name}_spread", f"""
select call_id, finding, string_agg(distinct cast(x as varchar), ',' order by cast(x as varchar)) as also from (
  select call_id, finding, anchor, case when i = finding then also_at else turn end as x from s_{name}_flags) q
where x is not null and x <> anchor and not exists (select 1 from s_{name}_flags a where a.call_id = q.call_id and a.anchor = q.x) group by 1, 2
""")
    step(f"s_{name}_merged", f"""
select f.call_id, anchor as turn, min_by(seq, i) as seq, min_by(coalesce(category, ''), i) as category, nullif(min_by(coalesce(severity, ''), -rk * {_BIG} + i), '') as severity,
  coalesce(max_by(source, i) filter (where i <> f.finding and source <> 'conduct_scan'), min_by(source, i)) as source, count(*) as flags_merged, coalesce(any_value(s.also), '') as also_at_turns
from s_{name}_flags f left join s_{name}_spread s on f.call_id = s.call_id and f.finding = s.finding group by f.call_id, f.finding, anchor
""")


_FLAG_ROWS = "select call_id, seq, seq // 2 * 3 as turn, case when seq % 3 = 2 then 'rude' else 'abusive' end as category, lower(severity) as severity, source, reason, also_at from v_upstream"
step("s_merge_in", _FLAG_ROWS)
_merge_sql("s_merge_in", "m")
_MERGED = ["call_id", "seq", "turn", "category", "severity", "source", "flags_merged", "also_at_turns"]


def merge_input(t: Inputs) -> DataFrame:
    """Upstream flags brought close together, in two categories."""
    rows = upstream(t)
    return rows.withColumns({
        "turn": F.floor(F.col("seq") / 2).cast("bigint") * 3, "category": F.when(F.col("seq") % 3 == 2, "rude").otherwise("abusive"), "severity": F.lower("severity")})


@query("win_10_merged_neighbours", f"select {', '.join(_MERGED)} from s_m_merged")
def win_10(t: Inputs) -> DataFrame:
    return flags.merge_neighbours(merge_input(t)).select(*_MERGED[:-1], _text("also_at_turns"))


step("s_scan_in", """
select call_id, seq + (select max(seq) + 1 from v_upstream x where x.call_id = v.call_id) as seq, turn * 2 as turn, category, severity, 'conduct_scan' as source, reason, cast(null as bigint) as also_at
from (select call_id, turn as seq, turn, 'rude' as category, severity, reason, flagged from v_verdicts) v where flagged
""")
step("s_both_in", "select call_id, seq, turn, category, severity, source, reason, also_at from s_merge_in where call_id in (select call_id from s_scan_in) union all select * from s_scan_in")
_merge_sql("s_both_in", "b")


def _scan(t: Inputs) -> DataFrame:
    return t.verdicts.where("flagged").select(
        "call_id", F.col("turn").alias("seq"), (F.col("turn") * 2).alias("turn"), F.lit("rude").alias("category"), "severity", F.lit("conduct_scan").alias("source"),
        "reason", F.array().cast("array<bigint>").alias("also_at_turns"))


@query("win_11_scan_flags_added", """
select c.call_id, greatest(coalesce(has, 0) - coalesce(had, 0), 0) as added from (select distinct call_id from s_scan_in) c
left join (select call_id, count(*) as had from s_merge_in group by 1) a on c.call_id = a.call_id left join (select call_id, count(*) as has from s_b_merged group by 1) b on c.call_id = b.call_id
""")
def win_11(t: Inputs) -> DataFrame:
    existing, scan = merge_input(t).drop("stated", "speaker", "phrase"), _scan(t)
    return flags.scan_flags_added(existing, flags.add_scan_flags(existing, scan), scan)


@query("win_11_with_scan_flags", """
select call_id, turn, category, severity, source, flags_merged from s_b_merged union all
select call_id, turn, category, severity, source, 1 from s_merge_in where call_id not in (select call_id from s_scan_in)
""")
def win_11_flags(t: Inputs) -> DataFrame:
    existing = merge_input(t).drop("stated", "speaker", "phrase")
    return flags.add_scan_flags(existing, _scan(t)).select("call_id", "turn", "category", "severity", "source", "flags_merged")


# The check keeps the findings of a call and type as a list and takes one flag after the other.
step("s_dedupe_in", f"""
select *, row_number() over (partition by call_id, flag_type order by seq) as i, list_sort(list_distinct(list_filter([turn_index, also_at, case when seq % 4 = 3 then 1 end], lambda x: x is not null))) as turns,
  case severity when 'low' then 0 when 'medium' then 1 else 2 end as rk
from (select call_id, seq, case when seq % 5 = 0 then 'abusive_language' else 'coercive_pressure' end as flag_type, lower(case when severity = 'critical' then 'low' else severity end) as severity, seq as turn_index,
        1 + seq % 3 as occurrences, also_at from v_upstream) x
""")
_NEW = "struct_pack(seq := {0}.seq, rk := {0}.rk, occ := cast({0}.occurrences as bigint), turns := {0}.turns, n := cast(1 as bigint))"
_HIT = "list_position(list_transform(w.kept, lambda k: len(list_intersect(k.turns, o.turns)) > 0), true)"
def dedupe_steps(source: str, name: str) -> None:
    step(name, DEDUPE.replace("s_dedupe_in", source))


DEDUPE = f"""
select * from (with recursive walk as (
  select o.call_id, o.flag_type, o.i, [{_NEW.format('o')}] as kept from s_dedupe_in o where i = 1
  union all
  select o.call_id, o.flag_type, o.i, case when coalesce({_HIT}, 0) = 0 then list_append(w.kept, {_NEW.format('o')})
    else list_transform(w.kept, lambda k, j: case when j = {_HIT} then struct_pack(seq := k.seq, rk := greatest(k.rk, o.rk),
      occ := greatest(k.occ, o.occurrences, len(list_distinct(list_concat(k.turns, o.turns)))), turns := list_sort(list_distinct(list_concat(k.turns, o.turns))), n := k.n + 1) else k end) end
  from walk w join s_dedupe_in o on o.call_id = w.call_id and o.flag_type = w.flag_type and o.i = w.i + 1)
select call_id, flag_type, unnest(kept) as k from walk w where i = (select max(i) from s_dedupe_in m where m.call_id = w.call_id and m.flag_type = w.flag_type)) z
"""

dedupe_steps("s_dedupe_in", "s_dedupe_walk")


def dedupe_input(t: Inputs) -> DataFrame:
    """Upstream flags as report flags of two types that share turns."""
    kind = F.when(F.col("seq") % 5 == 0, "abusive_language").otherwise("coercive_pressure")
    severity = F.lower(F.when(F.col("severity") == "critical", "low").otherwise(F.col("severity")))
    spread = F.array_compact(F.array(F.col("seq"), F.col("also_at"), F.when(F.col("seq") % 4 == 3, F.lit(1).cast("bigint"))))
    return t.upstream.select("call_id", "seq", kind.alias("flag_type"), severity.alias("severity"), F.col("seq").alias("turn_index"),
                             (F.col("seq") % 3 + 1).alias("occurrences"), spread.alias("occurrence_turns"),
                             F.col("phrase").alias("verbatim"), F.col("reason").alias("why_flagged"), "source")


@query("win_12_deduped_flags", """
select z.call_id, flag_type, k.seq as seq, case k.rk when 0 then 'low' when 1 then 'medium' else 'high' end as severity, k.occ as occurrences, array_to_string(k.turns, ',') as occurrence_turns, k.n as flags_merged,
  u.phrase as verbatim, u.reason as why_flagged, u.source as source from s_dedupe_walk z join v_upstream u on z.call_id = u.call_id and z.k.seq = u.seq
""")
def win_12(t: Inputs) -> DataFrame:
    return flags.dedupe_flags(dedupe_input(t)).select("call_id", "flag_type", "seq", "severity", "occurrences", _text("occurrence_turns"), "flags_merged", "verbatim", "why_flagged", "source")


@query("set_4_turn_sets", """
select call_id, seq, array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') as both, (len(list_intersect(a, b)) > 0) as meets, array_to_string(list_sort(list_filter(a, lambda x: not list_contains(b, x))), ',') as only_a
from (select call_id, seq, list_filter([seq, also_at], lambda x: x is not null) as a, [coalesce(stated, 0), 2] as b from v_upstream) x
""")
def set_4(t: Inputs) -> DataFrame:
    sets = t.upstream.select("call_id", "seq", F.array_compact(F.array("seq", "also_at")).alias("a"),
                             F.array(F.coalesce("stated", F.lit(0)), F.lit(2)).cast("array<bigint>").alias("b"))
    out = sets.select("call_id", "seq", F.array_sort(F.array_union("a", "b")).alias("both"), F.arrays_overlap("a", "b").alias("meets"),
                      F.array_sort(F.array_except("a", "b")).alias("only_a"))
    return out.select("call_id", "seq", _text("both"), "meets", _text("only_a"))


# --- run bookkeeping over the audit jobs ----------------------------------------------
_OUTCOME = "case event_type when 'click' then 'audited' when 'view' then 'audit_failed' when 'error' then 'audit_retryable' when 'signup' then 'ingest_failed' else 'audit_skipped' end"


def outcomes(t: Inputs) -> DataFrame:
    kind = (F.when(F.col("event_type") == "click", "audited").when(F.col("event_type") == "view", "audit_failed")
            .when(F.col("event_type") == "error", "audit_retryable").when(F.col("event_type") == "signup", "ingest_failed").otherwise("audit_skipped"))
    return t.events.select(F.col("user_id").alias("run_id"), "event_id", "ts", kind.alias("outcome"))


@query("ag_12_session_counts", f"""
select user_id as run_id, count_if(o = 'audited') as total_calls_processed, count_if(o in ('audit_failed', 'audit_retryable', 'ingest_failed')) as calls_failed, count_if(o = 'audit_skipped') as calls_skipped
from (select *, {_OUTCOME} as o from events) x group by 1
""")
def ag_12(t: Inputs) -> DataFrame:
    return bookkeeping.session_counts(outcomes(t), ["run_id"])


@query("ag_12_stage_counts", f"select user_id as run_id, count_if(o = 'audited') as audited, count_if(o = 'audit_failed') as audit_failed, count_if(o = 'ingest_failed') as ingest_failed from (select *, {_OUTCOME} as o from events) x group by 1")
def ag_12_stages(t: Inputs) -> DataFrame:
    return bookkeeping.run_metrics(outcomes(t), ["run_id"], values=["audited", "audit_failed", "ingest_failed"])


@query("prj_21_run_outcome", """
select run_id, outcome, case outcome when 'FAILED' then 2 when 'PARTIAL' then 1 else 0 end as exit_code from (
  select user_id as run_id, case when max(value) < 50 then 'FAILED' when count_if(event_type = 'error') > 0 then 'PARTIAL' else 'OK' end as outcome from events group by 1) x
""")
def prj_21(t: Inputs) -> DataFrame:
    runs = t.events.groupBy(F.col("user_id").alias("run_id")).agg((F.max("value") >= 50).alias("ran"), F.count_if(F.col("event_type") == "error").alias("failures"))
    ended = runs.withColumn("outcome", bookkeeping.run_outcome(F.col("ran"), F.col("failures")))
    return ended.select("run_id", "outcome", bookkeeping.exit_code(F.col("outcome")).alias("exit_code"))


@query("snk_8_run_summary", """
select user_id as run_id, max_by(cast(floor(value) as bigint), ts) filter (where event_type = 'click') as click, max_by(cast(floor(value) as bigint), ts) filter (where event_type = 'error') as error from events group by 1
""")
def snk_8(t: Inputs) -> DataFrame:
    appended = t.events.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("metric"), F.floor("value").cast("bigint").alias("value"), F.col("ts").alias("at"))
    return bookkeeping.run_summary(appended, ["click", "error"])


@query("snk_8_failures", """
select user_id as run_id, count(*) as failure_count, string_agg(props, '|' order by k) filter (where k < 50) as failures
from (select user_id, cast(floor(value) as bigint) as k, props from (select *, row_number() over (partition by user_id, floor(value) order by event_id) as rn from events where event_type = 'error') a where rn = 1) x group by 1
""")
def snk_8_failures(t: Inputs) -> DataFrame:
    bad = t.events.where("event_type = 'error'")
    place = F.floor("value").cast("bigint").alias("seq")
    first = bad.groupBy(F.col("user_id").alias("run_id"), place).agg(F.min_by("props", "event_id").alias("reason"))
    kept = bookkeeping.run_failures(first)
    joined = F.array_join("failures", "|")
    return kept.select("run_id", "failure_count", F.when(F.size("failures") > 0, joined).alias("failures"))


@query("prj_17_scan_severity", "select call_id, turn, coalesce(case severity when 'low' then 0 when 'medium' then 1 when 'high' then 2 end, -1) as rank from v_verdicts")
def severity_ranks(t: Inputs) -> DataFrame:
    return t.verdicts.select("call_id", "turn", F.coalesce(marks.severity_rank("severity"), F.lit(-1)).alias("rank"))


@query("str_10_shared_tokens", f"select call_id, objection_id, cast(len({_TOKENS.format('verbatim')}) as bigint) as tokens from v_objections")
def shared_tokens(t: Inputs) -> DataFrame:
    return t.objections.select("call_id", "objection_id", F.size(text.token_set("verbatim")).cast("bigint").alias("tokens"))

