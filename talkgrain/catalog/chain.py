"""Queries: the whole chain of steps after the model, its log and the scores that come of it.

Reports of conversations: their flags, quoted objections and the nested document of the first turn; marks of the orders with the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.catalog.conversation import turns
from talkgrain.catalog.flags import _TOKENS, _text, dedupe_steps, report_flags, type_sql, upstream
from talkgrain.catalog.registry import again, query, step
from talkgrain.catalog.report import first_documents
from talkgrain.catalog.scoring import _SCORE_COLUMNS
from talkgrain.catalog.tables import Inputs
from talkgrain.operators import chain

_FLAG_COLUMNS = ["call_id", "seq", "flag_type", "severity", "verbatim", "turn_index", "occurrences", "occurrence_turns", "why_flagged", "source"]


def chained(t: Inputs) -> tuple[chain.Reports, DataFrame]:
    own = t.turns_raw.select("call_id").distinct()
    of_calls = lambda rows: rows.join(own, "call_id", "left_semi")
    first = first_documents(t)
    nothing = first.schema["report"].dataType
    body = first.withColumn("report", F.struct(*[(F.lit(None).cast(f.dataType) if f.name in ("objections", "compliance_flags") else F.col(f"report.{f.name}")).alias(f.name) for f in nothing.fields]))
    quoted = F.when(F.col("repeated_at").isNotNull(), F.array("repeated_at")).otherwise(F.array().cast("array<bigint>"))
    made = chain.Reports(
        report_flags(t), t.quoted_objections.withColumn("repeated_at_turns", quoted).drop("repeated_at"), body, of_calls(t.continuity), of_calls(t.relevance), of_calls(t.card), of_calls(t.flows), of_calls(t.repeats))
    return chain.run(made, chain.Evidence(turns(t), upstream(t), t.dismissed, own))


step("s_chain_flags", f"""
select call_id, seq, flag_type, severity, verbatim, turn_index, occurrences, occurrence_turns, why_flagged, source from s_reanchored
union all
select j.call_id, j.seq + coalesce(x.top + 1, 0), {type_sql('j.category')}, j.severity, coalesce(nullif(trim(u.phrase), ''), t.text), j.turn, 1, j.occ, coalesce(nullif(u.reason, ''), 'Flagged by the sentiment layer.'), 'sentiment_layer'
from s_chain_judged2 j join s_chain_carry c on c.call_id = j.call_id and c.seq = j.seq and c.fate = 'carried' join v_upstream u on u.call_id = j.call_id and u.seq = j.seq
  left join s_turns t on t.call_id = j.call_id and t.turn = j.turn left join (select call_id, max(seq) as top from s_reanchored group by 1) x on x.call_id = j.call_id
""")
step("s_chain_dedupe_in", """
select *, row_number() over (partition by call_id, flag_type order by seq) as i, list_sort(list_distinct(list_append(occurrence_turns, turn_index))) as turns,
  case severity when 'low' then 0 when 'medium' then 1 else 2 end as rk from s_chain_flags
""")
dedupe_steps("s_chain_dedupe_in", "s_chain_walk")
step("s_chain_final", """
select z.call_id, z.k.seq as seq, f.flag_type, case z.k.rk when 0 then 'low' when 1 then 'medium' else 'high' end as severity, f.verbatim, f.turn_index, z.k.occ as occurrences, z.k.turns as turns, f.why_flagged, f.source, z.k.n as n
from s_chain_walk z join s_chain_flags f on f.call_id = z.call_id and f.seq = z.k.seq
""")


@query("win_13_post_steps", """
select call_id, seq, flag_type, severity, verbatim, turn_index, occurrences, array_to_string(turns, ',') as occurrence_turns, why_flagged, source from s_chain_final
""")
def win_13(t: Inputs) -> DataFrame:
    """The final flags, with quote and reason."""
    done, _ = chained(t)
    return done.flags.select(*[_text(c) if c == "occurrence_turns" else c for c in _FLAG_COLUMNS])


step("s_chain_docs", "select call_id, of_call from v_report where turn = (select min(turn) from v_report r where r.of_call = v_report.of_call)")
step("s_chain_cited", """
select of_call as call_id, turn from s_cited_turns c join s_chain_docs d on d.call_id = c.call_id where field <> 'turn_range' and path not like 'objections%' and path not like 'compliance_flags%'
union all select call_id, unnest(list_append(turns, turn_index)) from s_chain_final
union all select call_id, unnest([turn_index, repeated_at]) from v_quoted_objections
""")
step("s_chain_own", "select distinct call_id from v_turns_raw")
step("s_chain_forced", "select n.*, not is_follow_up and parent_id in (select call_id from s_chain_own) as forced from v_continuity n where call_id in (select call_id from s_chain_own)")
step("s_chain_repeats", f"""
select o.call_id, o.objection_id, s.turn
from (select *, {_TOKENS.format('verbatim')} as a from v_quoted_objections) o join (select *, {_TOKENS.format('text')} as b from s_turns where speaker = 'Customer') s on o.call_id = s.call_id
where s.turn < o.turn_index and s.turn is distinct from o.repeated_at and len(o.a) > 0 and len(s.b) > 0 and len(list_intersect(o.a, s.b)) / cast(least(len(o.a), len(s.b)) as double) >= {chain.REPEAT_SHARE}
""")


@query("win_13_change_log", """
select call_id, 'reanchor' as step, 'moved' as code, cast(seq as varchar) as subject, turn_index as at from s_reanchored where moved
union all select call_id, 'carry_over', 'unanchored', cast(seq as varchar), turn from s_chain_judged2 where not anchored
union all select call_id, 'carry_over', 'found_elsewhere', cast(seq as varchar), turn from s_chain_judged2 where anchored and stated is not null and turn <> stated
union all select j.call_id, 'carry_over', fate, cast(j.seq as varchar), turn from s_chain_judged2 j join s_chain_carry c on c.call_id = j.call_id and c.seq = j.seq where fate in ('dismissed', 'not_conduct')
union all select call_id, 'carry_over', 'carried', null, count(*) from s_chain_carry where fate = 'carried' group by call_id
union all select call_id, 'dedupe', 'merged', cast(seq as varchar), n from s_chain_final where n > 1
union all select of_call, 'scrub', 'citation_stripped', path, null from s_scrubbed s join s_chain_docs d on d.call_id = s.call_id where scrubbed
union all select of_call, 'check_ledger', 'empty_ledger', null, null from s_chain_docs d where not exists (select 1 from s_nodes n where n.call_id = d.call_id and in_list and starts_with(holder, 'sales_summary.carry_forward.'))
union all select call_id, 'check_repeats', 'unlinked_repeat', cast(objection_id as varchar), turn from s_chain_repeats
union all select distinct c.call_id, 'check_bounds', 'outside_transcript', null, c.turn from s_chain_cited c join s_sizes z on z.call_id = c.call_id where turn is not null and turn <> -1 and (turn < 0 or turn >= n)
union all select call_id, 'force_follow_up', 'forced', parent_id, null from s_chain_forced where forced
""")
def win_13_log(t: Inputs) -> DataFrame:
    """What each step changed or found."""
    return chained(t)[1]


step("s_chain_card", "select * from v_card where call_id in (select call_id from s_chain_own)")
step("s_chain_continuity", "select call_id, is_follow_up or forced as is_follow_up from s_chain_forced")
step("s_chain_repeats_listed", "select * from v_repeats where call_id in (select call_id from s_chain_own)")
again("chain_", ["s_card_1", "s_repeat_counts", "s_card_2", "s_card_3", "s_marked", "s_flag_totals", "s_scores", "s_call_warnings"],
      {"v_card": "s_chain_card", "v_continuity": "s_chain_continuity", "v_repeats": "s_chain_repeats_listed", "v_call_flags": "s_chain_final"})


@query("win_13_scores", f"select {', '.join(_SCORE_COLUMNS)} from s_chain_scores")
def win_13_scores(t: Inputs) -> DataFrame:
    """Scores after the last step: forced follow-ups, and final flags that may void a score."""
    return chain.scored(chained(t)[0])[0].select(*_SCORE_COLUMNS)


@query("win_13_score_log", """
select call_id, 'score' as step, warning as code, cast(null as varchar) as subject, n as at from s_chain_call_warnings
union all select call_id, 'score', w, criterion, null from (select call_id, criterion, unnest([case when flow_changed then 'flow_computed' end,
  case when deduction > 0 then 'repeat_deducted' end, case when repeat_on_unreached then 'repeat_on_unreached' end,
  case when relevance_changed then 'not_applicable' end, case when not reached and criterion = 'closing_and_follow_up' then 'unreached_with_notice' end,
  case when defaulted then 'unreached_full_marks' end, case when clamped then 'clamped' end]) as w from s_chain_marked) x where w is not null
""")
def win_13_score_log(t: Inputs) -> DataFrame:
    return chain.scored(chained(t)[0])[1]
