"""Queries: marking scheme, scorecard, audit documents, quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.catalog.log import band_sql
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.functions import marks
from talkgrain.operators import bookkeeping, calls, flags, quality, rollup, scorecard

_SCHEME = ", ".join(f"('{s}', '{c}', {m}, {list(b)})" for s, c, m, b in K.MARKING_SCHEME)
step("s_scheme", f"select * from (values {_SCHEME}) s(section, criterion, full_marks, bands)")


def step_down_sql(mark: str, steps: str) -> str:
    return (f"bands[greatest(greatest(len(list_filter(bands, lambda b: b <= {mark})), 1) - greatest({steps}, 0), 1)]")


# The steps of a marked card, each one reading the one before.
_BREAKS = " + ".join(f"cast({c} = 'broken' as int)" for c in K.FLOW_BREAK_TEXT)
_NEVER = " and ".join(f"{c} = 'not_reached'" for c in K.FLOW_BREAK_TEXT)
_SAYS = " or ".join(f"contains(lower(justification), '{w}')" for w in K.FLOW_BREAK_WORDS)
_NAMED = "concat_ws('; ', " + ", ".join(f"case when {c} = 'broken' then '{w}' end" for c, w in K.FLOW_BREAK_TEXT.items()) + ")"
step("s_flow", f"""
select call_id, not ({_NEVER}) as flow_reached, cast({_BREAKS} as bigint) as flow_breaks,
  case when {_NEVER} then 10 else cast([10, 7, 5, 0][{_BREAKS} + 1] as bigint) end as flow_awarded,
  case when {_BREAKS} > 0 and not ({_NEVER}) and not ({_SAYS}) then concat('{K.FLOW_BREAK_PREFIX}', {_NAMED}, '.') else justification end as justification
from v_flows
""")
step("s_card_1", """
select c.call_id, c.criterion, coalesce(f.flow_reached, c.reached) as reached, coalesce(f.flow_awarded, c.awarded) as awarded,
  coalesce(f.flow_reached and f.flow_awarded <> c.awarded, false) as flow_changed
from v_card c left join s_flow f on c.call_id = f.call_id and c.criterion = 'pitch_flow_order'
""")
step("s_repeat_counts", "select call_id, criterion, count(*) as repeats from v_repeats group by 1, 2")
step("s_card_2", f"""
select *, case when applies then before - after else 0 end as deduction, case when applies and after <> before then after else awarded_1 end as awarded from (
  select *, {step_down_sql('before', 'repeats')} as after from (
    select c.call_id, c.criterion, c.reached, c.awarded as awarded_1, c.flow_changed, coalesce(r.repeats, 0) as repeats, n.is_follow_up, s.full_marks, s.bands,
      (n.is_follow_up and c.reached and coalesce(r.repeats, 0) > 0) as applies,
      coalesce(n.is_follow_up and not c.reached and coalesce(r.repeats, 0) > 0, false) as repeat_on_unreached, least(c.awarded, s.full_marks) as before
    from s_card_1 c join s_scheme s on c.criterion = s.criterion left join s_repeat_counts r on c.call_id = r.call_id and c.criterion = r.criterion
      left join v_continuity n on c.call_id = n.call_id) x) y
""")
step("s_card_3", """
select call_id, criterion, full_marks, repeats, is_follow_up, deduction, repeat_on_unreached, flow_changed, not_applicable, is_relevant, awarded as awarded_2,
  (not_applicable and awarded <> full_marks) as relevance_changed, (not not_applicable and reached) as reached,
  case when not_applicable then full_marks else awarded end as awarded
from (select c.*, r.is_relevant, (not r.is_relevant and c.criterion in ('why_what_how_explanation', 'benefits_for_their_study')) as not_applicable
      from s_card_2 c left join v_relevance r on c.call_id = r.call_id) x
""")
step("s_marked", """
select * exclude (awarded), awarded as given, (not reached and awarded <> full_marks) as defaulted, (reached and awarded > full_marks) as clamped,
  case when not reached then full_marks else least(awarded, full_marks) end as awarded from s_card_3
""")
step("s_flag_totals", """
select call_id, count(*) as flag_count, coalesce(string_agg(distinct case when flag_type in ('abusive_language', 'discriminatory_remark') then flag_type end, ','
    order by case when flag_type in ('abusive_language', 'discriminatory_remark') then flag_type end), '') as disqualifying_flags,
  bool_or(flag_type in ('abusive_language', 'discriminatory_remark')) as disqualified from v_call_flags group by 1
""")


def marked(t: Inputs) -> DataFrame:
    return scorecard.marked_card(t.card, t.flows, t.repeats, t.continuity, t.relevance)


@query("scr_1_scheme_on_marks", """
select m.call_id, m.criterion, s.section, s.full_marks, (m.awarded > s.full_marks) as over_full from v_marks m join s_scheme s on m.criterion = s.criterion
""")
def scr_1(t: Inputs) -> DataFrame:
    scheme = F.broadcast(scorecard.criteria(t.spark))
    return t.marks.join(scheme, "criterion").select("call_id", "criterion", "section", "full_marks", (F.col("awarded") > F.col("full_marks")).alias("over_full"))


@query("scr_2_step_down", f"select m.call_id, m.criterion, cast({step_down_sql('m.awarded', 'm.awarded % 4')} as bigint) as stepped from v_marks m join s_scheme s on m.criterion = s.criterion")
def scr_2(t: Inputs) -> DataFrame:
    return t.marks.select("call_id", "criterion", marks.step_down("criterion", "awarded", F.col("awarded") % 4).alias("stepped"))


@query("scr_3_flow_mark", "select call_id, flow_reached, flow_breaks, flow_awarded from s_flow")
def scr_3(t: Inputs) -> DataFrame:
    return scorecard.flow_marks(t.flows).select("call_id", "flow_reached", "flow_breaks", "flow_awarded")


@query("str_16_flow_justification", "select call_id, justification from s_flow")
def str_16(t: Inputs) -> DataFrame:
    return scorecard.flow_marks(t.flows).select("call_id", "justification")


@query("scr_4_repetition", "select call_id, criterion, repeats, cast(deduction as bigint) as deduction, cast(awarded as bigint) as awarded from s_card_2")
def scr_4(t: Inputs) -> DataFrame:
    card = scorecard.apply_repetitions(scorecard.apply_flow(t.card, t.flows), t.repeats, t.continuity)
    return card.select("call_id", "criterion", "repeats", "deduction", "awarded")


@query("scr_5_irrelevant_lead", "select call_id, criterion, not_applicable, relevance_changed, reached, cast(awarded as bigint) as awarded from s_card_3")
def scr_5(t: Inputs) -> DataFrame:
    card = scorecard.apply_repetitions(scorecard.apply_flow(t.card, t.flows), t.repeats, t.continuity)
    return scorecard.apply_relevance(card, t.relevance).select("call_id", "criterion", "not_applicable", "relevance_changed", "reached", "awarded")


@query("scr_6_defaults_and_clamps", "select call_id, criterion, reached, defaulted, clamped, cast(awarded as bigint) as awarded from s_marked")
def scr_6(t: Inputs) -> DataFrame:
    return marked(t).select("call_id", "criterion", "reached", "defaulted", "clamped", "awarded")


@query("scr_6_warnings", """
select call_id, criterion, w as warning from (select call_id, criterion, unnest([case when flow_changed then 'flow_computed' end,
  case when deduction > 0 then 'repeat_deducted' end, case when repeat_on_unreached then 'repeat_on_unreached' end,
  case when relevance_changed then 'not_applicable' end, case when not reached and criterion = 'closing_and_follow_up' then 'unreached_with_notice' end,
  case when defaulted then 'unreached_full_marks' end, case when clamped then 'clamped' end]) as w from s_marked) x where w is not null
""")
def scr_6_warnings(t: Inputs) -> DataFrame:
    return scorecard.score_warnings(marked(t))


step("s_scores", """
select m.*, coalesce(f.flag_count, 0) as flag_count, coalesce(f.disqualified, false) as disqualified, round(earned_marks * 100.0e0 / 70, 1) as score_before_flags,
  case when coalesce(f.disqualified, false) then 0.0e0 else round(earned_marks * 100.0e0 / 70, 1) end as overall_score_100
from (select call_id, cast(sum(awarded) as bigint) as earned_marks, cast(sum(deduction) as bigint) as repetition_deductions, count_if(not_applicable) as not_applicable_criteria,
        any_value(is_follow_up) as is_follow_up, not any_value(is_relevant) as irrelevant_lead from s_marked group by 1) m left join s_flag_totals f on m.call_id = f.call_id
""")
_SCORE_COLUMNS = ["call_id", "earned_marks", "repetition_deductions", "not_applicable_criteria", "is_follow_up", "irrelevant_lead", "flag_count",
                  "disqualified", "score_before_flags", "overall_score_100"]


CALL_WARNINGS = """
select s.call_id, w.w as warning, w.n from s_scores s left join (select call_id, count(*) as repeats from v_repeats group by 1) r on r.call_id = s.call_id,
  unnest([struct_pack(w := case when not s.is_follow_up and repeats > 0 then 'repeats_without_follow_up' end, n := repeats), struct_pack(w := case when s.irrelevant_lead then 'irrelevant_lead' end, n := null),
    struct_pack(w := case when s.disqualified then 'score_voided' end, n := s.flag_count), struct_pack(w := case when not s.disqualified and s.flag_count > 0 then 'flags_recorded' end, n := s.flag_count)]) u(w)
where w.w is not null
"""
step("s_call_warnings", CALL_WARNINGS)


@query("scr_6_call_warnings", "select call_id, warning, n from s_call_warnings")
def scr_6_calls(t: Inputs) -> DataFrame:
    return scorecard.call_warnings(scorecard.scores(marked(t), flags.flag_totals(t.call_flags)), t.repeats)


@query("scr_7_scores", f"select {', '.join(_SCORE_COLUMNS)} from s_scores")
def scr_7(t: Inputs) -> DataFrame:
    return scorecard.scores(marked(t), flags.flag_totals(t.call_flags)).select(*_SCORE_COLUMNS)


@query("scr_7_section_totals", """
select m.call_id, s.section, cast(sum(m.awarded) as bigint) as section_marks, cast(sum(s.full_marks) as bigint) as section_max
from s_marked m join s_scheme s on m.criterion = s.criterion group by 1, 2
""")
def scr_7_sections(t: Inputs) -> DataFrame:
    return scorecard.section_totals(marked(t))


@query("scr_8_score_band", f"select call_id, {band_sql('score')} as score_band from v_calls")
def scr_8(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", marks.score_band("score").alias("score_band"))


@query("scr_9_synthetic_audits", """
select call_id, round(55.0e0 + (seed % 400) / 10.0e0, 1) as score, seed % 4 as flag_count, round(0.3e0 + (seed % 50) / 100.0e0, 4) as talk_ratio, 20 + seed % 40 as total_turns,
  round((seed % 90) / 100.0e0, 2) as conversion_probability,
  ['committed', 'interested_no_commitment', 'callback_requested', 'not_interested', 'demo_agreed'][seed % 5 + 1] as outcome
from (select call_id, cast(concat('0x', left(sha256(call_id), 8)) as bigint) as seed from v_calls) x
""")
def scr_9(t: Inputs) -> DataFrame:
    return scorecard.synthetic_audits(t.calls.select("call_id"))


@query("scr_10_scheme_faults", """
select call_id, subject, fault from v_card join (
  select criterion, criterion as subject, 'bands do not run upward from 0' as fault from s_scheme where list_sort(bands) <> bands or bands[1] <> 0
  union all select criterion, criterion, 'top band is not full marks' from s_scheme where bands[len(bands)] <> full_marks) f using (criterion)
""")
def scr_10(t: Inputs) -> DataFrame:
    """Marks that were given under a faulty line of the scheme."""
    faults = scorecard.scheme_faults(scorecard.criteria(t.spark))
    return t.card.join(F.broadcast(faults), F.col("criterion") == F.col("subject")).select("call_id", "subject", "fault")


@query("scr_11_two_way_advice", "select call_id, cast([10, 7, 5, 2][least(coalesce(flag_count, 0), 3) + 1] as bigint) as advice from v_calls")
def scr_11(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", marks.two_way_advice(F.coalesce("flag_count", F.lit(0))).alias("advice"))


@query("ag_24_flag_totals", "select call_id, flag_count, disqualifying_flags, disqualified from s_flag_totals")
def ag_24(t: Inputs) -> DataFrame:
    return flags.flag_totals(t.call_flags).withColumn("disqualifying_flags", F.array_join("disqualifying_flags", ","))


@query("jsn_4_marks_map", "select call_id, criterion, cast(awarded as bigint) as awarded from s_marked")
def jsn_4(t: Inputs) -> DataFrame:
    return scorecard.marks_map(marked(t)).select("call_id", F.explode("criterion_marks").alias("criterion", "awarded"))


@query("jsn_3_decimal_round_trip", "select call_id, score, cast(duration_sec as bigint) as duration_sec from v_calls where score is not null")
def jsn_3(t: Inputs) -> DataFrame:
    stored = t.calls.where("score is not null").select("call_id", F.col("score").cast("decimal(38,18)").alias("s"), F.col("duration_sec").cast("decimal(38,0)").alias("d"))
    return stored.select("call_id", F.col("s").cast("double").alias("score"), F.col("d").cast("bigint").alias("duration_sec"))


@query("jsn_5_metadata", "select o_orderkey, lower(k) as key, v as value from (select o_orderkey, unnest(['CallId', 'Status', 'Priority']) as k, unnest([cast(o_orderkey as varchar), case when o_orderstatus = 'P' then null else o_orderstatus end, o_orderpriority]) as v from orders) x where v is not null")
def jsn_5(t: Inputs) -> DataFrame:
    raw = F.create_map(F.lit("CallId"), F.col("o_orderkey").cast("string"), F.lit("Status"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
                       F.lit("Priority"), F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", F.explode(bookkeeping.string_metadata(raw)).alias("key", "value"))


# --- audit documents -------------------------------------------------------------
def audit_documents(t: Inputs) -> DataFrame:
    """An audit document per call as JSON text, then read back with the declared schema."""
    levels = F.array(*map(F.lit, ("high", "low", "bogus", "medium")))
    listed = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.struct(F.element_at(levels, ((i + F.col("k")) % 4 + 1).cast("int")).alias("severity")))
    many = F.when(F.col("n") > 0, listed).otherwise(F.array().cast("array<struct<severity:string>>"))
    rows = t.calls.withColumns({"n": F.coalesce("flag_count", F.lit(0)).cast("int"), "k": F.col("call_id").cast("bigint") % 4})
    score = F.struct(F.coalesce("score", F.lit(0.0)).alias("overall_score_100"),
                     F.when(F.col("duration_sec") % 2 == 0, F.col("flag_count")).alias("flag_count"),
                     F.when(F.col("disqualified"), F.lit(True)).alias("disqualified"),
                     F.create_map(F.lit("purpose_of_call"), F.col("duration_sec") % 6).alias("criterion_marks"))
    body = F.to_json(F.struct("call_id", score.alias("scores"), F.struct(many.alias("compliance_flags")).alias("report")))
    return rows.select("call_id", F.from_json(body, schemas.AUDIT_DOCUMENT).alias("doc"))


_WORST = """
(select ['LOW', 'MEDIUM', 'HIGH'][max(case s when 'low' then 1 when 'medium' then 2 when 'high' then 3 end)]
 from (select ['high', 'low', 'bogus', 'medium'][(i + cast(call_id as bigint) % 4) % 4 + 1] as s from range(1, coalesce(flag_count, 0) + 1) r(i)) z)
"""


@query("prj_10_dashboard_fields", f"""
select call_id, case when not disqualified then coalesce(score, 0) end as score,
  coalesce(case when duration_sec % 2 = 0 then flag_count end, coalesce(flag_count, 0)) as flag_count, {_WORST} as audit_status, disqualified, duration_sec % 6 as purpose_marks from v_calls
""")
def prj_10(t: Inputs) -> DataFrame:
    fields = calls.dashboard_fields(audit_documents(t))
    return fields.select("call_id", "score", "flag_count", "audit_status", "disqualified", F.try_element_at("criterion_marks", F.lit("purpose_of_call")).alias("purpose_marks"))


@query("prj_11_worst_severity", f"select call_id, {_WORST} as audit_status from v_calls")
def prj_11(t: Inputs) -> DataFrame:
    listed = F.transform("doc.report.compliance_flags", lambda f: f["severity"])
    return audit_documents(t).select("call_id", calls.worst_severity(listed).alias("audit_status"))


@query("prj_30_forced_follow_up", """
select call_id, (is_follow_up or has) as is_follow_up, (has and not is_follow_up) as forced,
  case when has and not is_follow_up then coalesce(nullif(basis, ''), concat('The previous call (', parent_id, ') was audited on this student; the transcript itself carries no reference back to it.')) else basis end as basis
from (select c.*, p.call_id is not null as has from v_continuity c left join (select call_id from v_calls where processing_status = 'PROCESSED') p on c.parent_id = p.call_id) x
""")
def prj_30(t: Inputs) -> DataFrame:
    done = t.calls.where("processing_status = 'PROCESSED'").select("call_id")
    return scorecard.force_follow_up(t.continuity, done).select("call_id", "is_follow_up", "forced", "basis")


@query("jn_6_parent_audit", """
select f.call_id, f.follow as is_follow_up_id, p.score as parent_score, (f.follow and p.call_id is null) as parent_missing
from (select case when call_direction = 'INBOUND' then concat(cast(cast(call_id as bigint) + 1 as varchar), '_follow_up') else call_id end as call_id,
        case when call_direction = 'INBOUND' then cast(cast(call_id as bigint) + 1 as varchar) end as parent, call_direction = 'INBOUND' as follow from v_calls) f
left join (select * from v_calls where processing_status = 'PROCESSED') p on f.parent = p.call_id
""")
def jn_6(t: Inputs) -> DataFrame:
    later = F.concat((F.col("call_id").cast("bigint") + 1).cast("string"), F.lit(K.FOLLOW_UP_SUFFIX))
    named = t.calls.select(F.when(F.col("call_direction") == "INBOUND", later).otherwise(F.col("call_id")).alias("call_id"))
    done = t.calls.where("processing_status = 'PROCESSED'")
    return bookkeeping.with_parent(named, done, ["score"]).select("call_id", "is_follow_up_id", "parent_score", "parent_missing")


# --- quality rules -----------------------------------------------------------------
@query("dq_1_enums", """
select call_id, objection_id, 'enum' as rule, 'objection_type' as field from v_objections where objection_type not in ('already_enrolled_competitor', 'price', 'trust_credibility',
  'parent_decision', 'time_availability', 'language_medium', 'content_doubt', 'not_interested', 'no_objection_raised', 'other')
""")
def dq_1(t: Inputs) -> DataFrame:
    return quality.violations(t.objections, [quality.enum_rule("objection_type", "objection_type")], ["call_id", "objection_id"])


@query("dq_2_ranges", """
select call_id, criterion, 'range' as rule, 'awarded' as field from v_card where awarded < 0 or awarded > 10
""")
def dq_2(t: Inputs) -> DataFrame:
    return quality.violations(t.card, [quality.range_rule("awarded")], ["call_id", "criterion"])


@query("dq_2_probabilities", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, f as field, 'range' as rule from (
  select *, unnest([case when l_discount * 20 < 0 or l_discount * 20 > 1 then 'conversion_probability' end, case when l_quantity / 40 > 1 then 'talk_ratio' end, case when l_tax = 0 then 'occurrences' end]) as f from lineitem) x where f is not null
""")
def dq_2_more(t: Inputs) -> DataFrame:
    rows = t.lineitem.withColumns({"p": F.col("l_discount") * 20, "r": F.col("l_quantity") / 40, "o": F.when(F.col("l_tax") == 0, 0).otherwise(1)})
    rules = [quality.range_rule("conversion_probability", column="p"), quality.range_rule("talk_ratio", column="r"), quality.range_rule("occurrences", column="o")]
    return quality.violations(rows, rules, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("dq_3_list_sizes", r"""
select doc_id, 'size' as rule, unnest(['strengths', 'snapshot_points', 'questions_asked']) as field from documents where false
union all select doc_id, 'size', f from (select doc_id, unnest([case when n < 2 or n > 4 then 'strengths' end, case when n < 2 or n > 6 then 'snapshot_points' end, case when n > 12 then 'questions_asked' end]) as f
  from (select doc_id, len(string_split(text, chr(10))) as n from documents) x) y where f is not null
""")
def dq_3(t: Inputs) -> DataFrame:
    lines = t.documents.select("doc_id", F.split("text", "\n").alias("lines"))
    rules = [quality.size_rule(f, column="lines") for f in ("strengths", "snapshot_points", "questions_asked")]
    return quality.violations(lines, rules, ["doc_id"])


@query("dq_4_text_caps", r"""
select doc_id, rule, field from (
  select doc_id, 'length' as rule, case when length(text) > 2500 then 'what_happened' end as field from documents
  union all select doc_id, 'length', case when length(text) > 800 then 'call_tone' end from documents
  union all select doc_id, 'item_length', case when len(list_filter(string_split(text, chr(10)), lambda v: length(v) > 400)) > 0 then 'open_threads' end from documents) x where field is not null
""")
def dq_4(t: Inputs) -> DataFrame:
    docs = t.documents.select("doc_id", "text", F.split("text", "\n").alias("lines"))
    rules = [quality.length_rule("what_happened", column="text"), quality.length_rule("call_tone", column="text"), quality.item_length_rule("open_threads", column="lines")]
    return quality.violations(docs, rules, ["doc_id"])


_UNANCHORED = "select call_id, objection_id, objection_type, case when length(verbatim) % 4 = 0 then null else turn_index end as turn_index from v_objections"


@query("dq_5_anchoring", f"""
select call_id, objection_id, case when objection_type = 'no_objection_raised' and turn_index is null then -1 else turn_index end as turn_index,
  (objection_type <> 'no_objection_raised' and coalesce(turn_index, -1) < 0) as broken from ({_UNANCHORED}) x
""")
def dq_5(t: Inputs) -> DataFrame:
    missing = F.when(F.length("verbatim") % 4 != 0, F.col("turn_index"))
    fixed = quality.repair_anchor(t.objections.withColumn("turn_index", missing))
    return fixed.select("call_id", "objection_id", "turn_index", quality.anchor_rule().broken.alias("broken"))


@query("dq_6_known_criteria", "select call_id, count(*) as unknown from (select call_id, concat(criterion, case when call_id like '%7' then '_x' else '' end) as criterion from v_repeats) x where criterion not in (select criterion from s_scheme) group by 1")
def dq_6(t: Inputs) -> DataFrame:
    odd = t.repeats.withColumn("criterion", F.concat("criterion", F.when(F.col("call_id").endswith("7"), "_x").otherwise("")))
    return quality.violations(odd, [quality.criterion_rule()], ["call_id"]).groupBy("call_id").agg(F.count("*").alias("unknown"))


@query("dq_7_empty_ledger", "select cast(doc_id as varchar) as call_id, 'empty_ledger' as warning from documents where text not like '%?%' and text not like '%' || chr(10) || '%'")
def dq_7(t: Inputs) -> DataFrame:
    asked = F.filter(F.split("text", "(?<=\\?)"), lambda s: s.endswith("?"))
    given = F.when(F.contains("text", F.lit("\n")), F.split("text", "\n")).otherwise(F.array().cast("array<string>"))
    ledgers = t.documents.select(F.col("doc_id").cast("string").alias("call_id"), asked.alias("questions_asked"), given.alias("information_given"))
    return quality.ledger_warnings(ledgers, ["questions_asked", "information_given"])


@query("jsn_1_unknown_keys", "select event_id, k as unknown_key from (select event_id, unnest(json_keys(props)) as k from events) x where k not in ('id', 'page')")
def jsn_1(t: Inputs) -> DataFrame:
    return quality.unknown_keys(t.events, ["id", "page"], "props").select("event_id", "unknown_key")


@query("ag_9_marks_as_map", "select call_id, cast(sum(awarded) as bigint) as marks_sum, count(*) as criteria from v_marks group by 1")
def ag_9_map(t: Inputs) -> DataFrame:
    nested = rollup.as_map(t.marks, ["call_id"], "criterion", "awarded", "criterion_marks")
    total = F.aggregate(F.map_values("criterion_marks"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return nested.select("call_id", total.alias("marks_sum"), F.size("criterion_marks").cast("bigint").alias("criteria"))
