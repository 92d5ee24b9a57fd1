"""Queries: transcripts, turns, talk metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.functions import text
from talkgrain.operators import conversation
from talkgrain.plans import ordered
from talkgrain.sources import storage, transcripts

MAX_GAP_MS = 150

_FLAT = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_TIDY = r"regexp_replace(" + _FLAT + r", '\s+([।,.?!])', '\1', 'g')"
_WORDS = r"len(list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> ''))"

step("s_turns", f"""
select call_id, row_number() over (partition by call_id order by pos) - 1 as turn, speaker, text, start_ms, end_ms, raw_speaker from (
  select call_id, pos, case when lower(trim(speaker)) = 'employee' then 'Employee' else 'Customer' end as speaker, speaker as raw_speaker, {_FLAT.format('text')} as text, start_ms, end_ms
  from v_turns_raw) x where text <> ''
""")
step("s_clean", f"""
select call_id, pos, start_ms, end_ms, {_TIDY.format('text')} as text,
  case lower(trim(speaker)) when 'employee' then 'Employee' when 'agent' then 'Employee' when 'sales' then 'Employee' when 'customer' then 'Customer'
    when 'user' then 'Customer' when 'student' then 'Customer' when 'client' then 'Customer' else trim(speaker) end as role
from v_turns_raw where {_FLAT.format('text')} <> ''
""")
step("s_merged", """
select call_id, island as turn, any_value(role) as role, string_agg(text, ' ' order by pos) as text, count(*) as merged_turns, min_by(start_ms, pos) as start_ms, max_by(end_ms, pos) as end_ms
from (select *, sum(changed) over (partition by call_id order by pos) as island
      from (select *, case when lag(role) over (partition by call_id order by pos) <> role then 1 else 0 end as changed from s_clean) x) y
group by call_id, island
""")


def turns(t: Inputs) -> DataFrame:
    """The audit reader's turns of the conversations, numbered from 0."""
    return transcripts.numbered_turns(transcripts.apply_speaker_policy(t.turns_raw, "binary"))


def cleaned(t: Inputs) -> DataFrame:
    return conversation.clean_turns(t.turns_raw)


def segments(t: Inputs) -> DataFrame:
    return transcripts.timing_segments(t.turns_raw.withColumn("speaker", text.binary_speaker("speaker")))


def _documents(t: Inputs) -> DataFrame:
    """Each document's lines as a transcript, by turns in the detailed and in the role layout."""
    lines = F.split("text", "\n")
    who = lambda i: F.when(i % 3 == 0, "Employee").when(i % 3 == 1, " agent").otherwise("Student")
    detailed = F.to_json(F.struct(F.transform(lines, lambda v, i: F.struct(
        who(i).alias("speaker"), F.when(i % 2 == 0, v).alias("text"), F.when(i % 2 == 1, v).alias("statement"))).alias("transcript")))
    bare = F.to_json(F.transform(lines, lambda v, i: F.create_map(who(i), v)))
    return t.documents.select(F.col("doc_id").cast("string").alias("call_id"), F.when(F.length("text") % 2 == 0, detailed).otherwise(bare).alias("body"))


_LINES = """
(select doc_id, i, case i % 3 when 0 then 'Employee' when 1 then ' agent' else 'Student' end as who, line
 from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents) z)
"""


@query("src_4_transcript_documents", f"""
select cast(doc_id as varchar) as call_id, row_number() over (partition by doc_id order by i) - 1 as turn, trim(line) as text
from {_LINES} x where trim(line) <> ''
""")
def src_4(t: Inputs) -> DataFrame:
    return transcripts.read_turns(_documents(t), speaker_policy="raw").select("call_id", "turn", F.trim("text").alias("text"))


@query("src_5_speaker_policy", """
select call_id, pos, case when lower(trim(speaker)) = 'employee' then 'Employee' else 'Customer' end as binary_speaker, speaker as raw_speaker from v_turns_raw
""")
def src_5(t: Inputs) -> DataFrame:
    both = transcripts.apply_speaker_policy(t.turns_raw.withColumn("raw_speaker", F.col("speaker")), "binary")
    return both.select("call_id", "pos", F.col("speaker").alias("binary_speaker"), "raw_speaker")


@query("src_5_audit_reader", f"""
select cast(doc_id as varchar) as call_id, row_number() over (partition by doc_id order by i) - 1 as turn,
  case when lower(trim(who)) = 'employee' then 'Employee' else 'Customer' end as speaker from {_LINES} x where trim(line) <> ''
""")
def src_5_reader(t: Inputs) -> DataFrame:
    return transcripts.read_turns(_documents(t)).select("call_id", "turn", "speaker")


@query("src_9_durations", """
select call_id, count(*) as segments, max_by(end_ms, start_ms) as last_end_ms, coalesce(case when cast(call_id as bigint) % 2 = 0 then 1000 * cast(call_id as bigint) end, max_by(end_ms, start_ms)) as duration_ms
from v_turns_raw where end_ms >= start_ms group by call_id
""")
def src_9(t: Inputs) -> DataFrame:
    number = F.col("conv_id")
    stated = t.conversations.select(number.cast("string").alias("call_id"), F.when(number % 2 == 0, number * 1000).otherwise(-1).alias("audio_duration_ms")).distinct()
    return transcripts.call_durations(segments(t), stated).select("call_id", "segments", "last_end_ms", "duration_ms")


@query("prj_13_sentiment_fields", r"""
select cast(doc_id as varchar) as call_id, lang as overall_sentiment, cast(n_chars as double) as sentiment_score, trim(regexp_replace(text, '\s+', ' ', 'g')) as notes, 'kept phrase' as first_phrase, 1 as phrases
from documents
""")
def prj_13(t: Inputs) -> DataFrame:
    inner = F.struct(F.col("lang").alias("overall_sentiment"), F.col("n_chars").cast("double").alias("sentiment_score"), F.col("text").alias("notes"), F.col("source").alias("not_declared"),
                     F.array(F.struct(F.lit("kept  phrase").alias("phrase"), F.lit(3).alias("turn"))).alias("flagged_phrases"))
    wrapped, bare = F.to_json(F.struct(inner.alias("analysis"))), F.to_json(inner)
    docs = t.documents.select(F.col("doc_id").cast("string").alias("call_id"), F.when(F.col("doc_id") % 2 == 0, wrapped).otherwise(bare).alias("body"))
    found = transcripts.sentiment_fields(docs)
    return found.select("call_id", "hypothesis.overall_sentiment", "hypothesis.sentiment_score", "hypothesis.notes",
                        F.col("hypothesis.flagged_phrases")[0]["phrase"].alias("first_phrase"), F.size("hypothesis.flagged_phrases").cast("bigint").alias("phrases"))


@query("prj_14_previous_call", """
select call_id, outcome, primary_blocker, case when n > 0 then n end as questions, (n = 0) as ledger_empty from (
  select cast(doc_id as varchar) as call_id, source as outcome, nullif(case when lang = 'en' then '' else lang end, '') as primary_blocker,
    len(list_filter(string_split(text, chr(10)), lambda v: v like '%?%')) as n from documents) x
""")
def prj_14(t: Inputs) -> DataFrame:
    asked = F.filter(F.split("text", "\n"), lambda v: F.contains(v, F.lit("?")))
    ledger = F.struct(asked.alias("questions_asked"))
    report = F.struct(F.struct(F.col("source").alias("outcome")).alias("outcome_block"),
                      F.struct(F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("primary_blocker"), ledger.alias("carry_forward")).alias("sales_summary"))
    body = F.to_json(F.struct(F.col("doc_id").cast("string").alias("call_id"), report.alias("report")))
    doc = F.from_json(body, schemas.AUDIT_DOCUMENT)
    parsed = t.documents.select(doc.alias("d")).select("d.call_id", "d.report.outcome_block.outcome", "d.report.sales_summary.*")
    lists = F.array(*[F.coalesce(F.size(f"carry_forward.{f.name}"), F.lit(0)) for f in schemas.CARRY_FORWARD.fields])
    count = F.size("carry_forward.questions_asked").cast("bigint")
    return parsed.select("call_id", text.blank_to_null("outcome").alias("outcome"), text.blank_to_null("primary_blocker").alias("primary_blocker"),
                         F.nullif(count, F.lit(0).cast("bigint")).alias("questions"), (~F.exists(lists, lambda n: n > 0)).alias("ledger_empty"))


@query("prj_15_roles", """
select call_id, pos, role, case role when 'Employee' then 'Customer' when 'Customer' then 'Employee' else role end as swapped from s_clean
""")
def prj_15(t: Inputs) -> DataFrame:
    return t.turns_raw.select("call_id", "pos", text.normalise_role("speaker").alias("role"), text.normalise_role("speaker", swap=True).alias("swapped"))


@query("prj_16_employee", "select call_id, pos, lower(trim(speaker)) in ('employee', 'agent', 'sales', 'counsellor') as is_employee from v_turns_raw")
def prj_16(t: Inputs) -> DataFrame:
    return t.turns_raw.select("call_id", "pos", text.is_employee("speaker").alias("is_employee"))


_WORD_LIST = ", ".join("'" + w + "'" for w in K.BACKCHANNEL_WORDS)
_SHORT = r"list_filter(list_transform(regexp_split_to_array(replace({0}, '।', ' '), '\s+'), lambda w: lower(trim(w, ' .,!?।-–—…""''‘’“”'))), lambda w: w <> '')"


def backchannel_sql(column: str) -> str:
    words = _SHORT.format(column)
    return f"(len({words}) <= 3 and len(list_filter({words}, lambda w: w not in ({_WORD_LIST}))) = 0)"


# Single words of the documents, so that there are acknowledgements among them.
@query("prj_17_backchannel", f"""
select doc_id, count(*) as lines, count_if({backchannel_sql('line')}) as backchannels from (
  select doc_id, unnest(string_split(replace(text, ' ', chr(10)), chr(10))) as line from documents) x group by 1
""")
def prj_17(t: Inputs) -> DataFrame:
    words = t.documents.select("doc_id", F.explode(F.split(F.replace("text", F.lit(" "), F.lit("\n")), "\n")).alias("line"))
    return words.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(text.is_backchannel("line")).alias("backchannels"))


_FILLERS = ", ".join("'" + w + "'" for w in K.FILLER_WORDS)


@query("prj_18_fillers", f"""
select doc_id, count_if(lower(trim(w, ' ।.?!,')) in ({_FILLERS})) as fillers, count(*) as words from (
  select doc_id, unnest(string_split(concat(text, ' Ok. hmm, ', lang), ' ')) as w from documents) x group by 1
""")
def prj_18(t: Inputs) -> DataFrame:
    words = t.documents.select("doc_id", F.explode(F.split(F.concat("text", F.lit(" Ok. hmm, "), "lang"), " ")).alias("w"))
    return words.groupBy("doc_id").agg(F.count_if(text.is_filler("w")).alias("fillers"), F.count("*").alias("words"))


@query("win_1_merged_turns", "select call_id, turn, role, text, merged_turns, start_ms, end_ms from s_merged")
def win_1(t: Inputs) -> DataFrame:
    return conversation.merged_turns(cleaned(t)).select("call_id", "turn", "role", "text", "merged_turns", "start_ms", "end_ms")


# The check follows one token after the other.
step("s_spoken", "select *, row_number() over (partition by call_id order by pos) as i from v_tokens where trim(text, ' ' || chr(10) || chr(9)) <> ''")
step("s_walk", f"""
select * from (with recursive walk as (
  select call_id, i, pos, speaker, start_ms, end_ms, 0 as utterance, true as opens from s_spoken where i = 1
  union all
  select s.call_id, s.i, s.pos, s.speaker, s.start_ms,
    case when s.speaker <> w.speaker or coalesce(s.start_ms - w.end_ms > {MAX_GAP_MS}, false) then s.end_ms else coalesce(s.end_ms, w.end_ms) end,
    w.utterance + case when s.speaker <> w.speaker or coalesce(s.start_ms - w.end_ms > {MAX_GAP_MS}, false) then 1 else 0 end,
    s.speaker <> w.speaker or coalesce(s.start_ms - w.end_ms > {MAX_GAP_MS}, false)
  from walk w join s_spoken s on s.call_id = w.call_id and s.i = w.i + 1)
select * from walk) z
""")
step("s_placed", """
select t.call_id, t.pos, t.text, max(w.utterance) over (partition by t.call_id order by t.pos) as utterance
from v_tokens t left join s_walk w on t.call_id = w.call_id and t.pos = w.pos
""")
step("s_utterances", r"""
select p.call_id, p.utterance, p.text, w.speaker_id, w.start_ms, w.end_ms from
  (select call_id, utterance, trim(regexp_replace(string_agg(text, '' order by pos), '\s+', ' ', 'g')) as text from s_placed where utterance is not null group by 1, 2) p
  join (select call_id, utterance, any_value(speaker) as speaker_id, min_by(start_ms, pos) filter (where opens) as start_ms, max_by(end_ms, pos) as end_ms from s_walk group by 1, 2) w
  on p.call_id = w.call_id and p.utterance = w.utterance
""")


def spoken(t: Inputs) -> DataFrame:
    return conversation.utterances(t.tokens, MAX_GAP_MS)


@query("win_2_utterances", "select call_id, utterance, speaker_id, text, start_ms, end_ms from s_utterances")
def win_2(t: Inputs) -> DataFrame:
    return spoken(t).select("call_id", "utterance", "speaker_id", "text", "start_ms", "end_ms")


PLUS, MINUS = (*K.EMPLOYEE_MARKERS, "the", "und"), (*K.CUSTOMER_MARKERS, "eau", "ing")


def _hits(markers: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"cast(contains(lower(text), '{m}') as int)" for m in markers) + ")"


step("s_scores_by_speaker", f"""
select call_id, speaker_id, cast(sum({_hits(PLUS)} - {_hits(MINUS)}) as bigint) as marker_score, cast(sum(length(text)) as bigint) as chars, count(*) as utterances,
  min(utterance) as first_pos, min_by(coalesce(start_ms, -1), utterance) as first_ms from s_utterances group by 1, 2
""")
step("s_employees", """
select call_id, case when count_if(marker_score = top) = 1 then max(case when marker_score = top then speaker_id end) else arg_max(speaker_id, chars * 1000000 - first_pos) end as employee_speaker
from (select *, max(marker_score) over (partition by call_id) as top from s_scores_by_speaker) x group by 1
""")


def scores(t: Inputs) -> DataFrame:
    return conversation.speaker_scores(spoken(t), PLUS, MINUS)


@query("ag_16_speaker_scores", "select call_id, speaker_id, marker_score, chars, utterances, nullif(first_ms, -1) as first_ms from s_scores_by_speaker")
def ag_16(t: Inputs) -> DataFrame:
    return scores(t).select("call_id", "speaker_id", "marker_score", "chars", "utterances", "first_ms")


@query("ag_17_employee_pick", "select call_id, employee_speaker from s_employees")
def ag_17(t: Inputs) -> DataFrame:
    return conversation.employee_speaker(scores(t)).select("call_id", "employee_speaker")


_CLOCK = "case when {0} is null then null else concat(lpad(cast({0} // 3600000 as varchar), 2, '0'), ':', lpad(cast({0} // 60000 % 60 as varchar), 2, '0'), ':', lpad(cast({0} // 1000 % 60 as varchar), 2, '0'), '.', lpad(cast({0} % 1000 as varchar), 3, '0')) end"


@query("prj_28_roles_assigned", f"""
select u.call_id, utterance, case when speaker_id = employee_speaker then 'Employee' else 'Customer' end as speaker, {_CLOCK.format('start_ms')} as "start", {_CLOCK.format('end_ms')} as "end"
from s_utterances u join s_employees e on u.call_id = e.call_id
""")
def prj_28(t: Inputs) -> DataFrame:
    heard = ordered.cut(spoken(t))
    who = conversation.employee_speaker(conversation.speaker_scores(heard, PLUS, MINUS))
    return conversation.assign_roles(heard, who).select("call_id", "utterance", "speaker", "start", "end")


@query("prj_28_speaker_mapping", """
select s.call_id, speaker_id, case when speaker_id = employee_speaker then 'Employee' else 'Customer' end as role, 'auto' as detection
from s_scores_by_speaker s join s_employees e on s.call_id = e.call_id
""")
def prj_28_mapping(t: Inputs) -> DataFrame:
    scored = ordered.cut(scores(t))
    return conversation.speaker_mapping(scored, conversation.employee_speaker(scored))


# --- talk pattern --------------------------------------------------------------
step("s_segments", """
select call_id, pos, start_ms, end_ms, case when lower(trim(speaker)) = 'employee' then 'Employee' else 'Customer' end as speaker,
  sum(case when lower(trim(speaker)) = 'employee' then 0 else 1 end) over (partition by call_id order by start_ms, pos) as customers,
  last_value(end_ms) over (partition by call_id order by start_ms, pos rows between unbounded preceding and unbounded following) as call_end_ms
from v_turns_raw where end_ms >= start_ms
""")
step("s_stretches", """
select e.call_id, e.customers as stretch, e.from_ms, greatest(coalesce(c.start_ms, e.call_end_ms) - e.from_ms, 0) as stretch_ms
from (select call_id, customers, min(start_ms) as from_ms, any_value(call_end_ms) as call_end_ms from s_segments where speaker = 'Employee' group by 1, 2) e
left join (select * from s_segments where speaker <> 'Employee') c on e.call_id = c.call_id and c.customers = e.customers + 1
""")
step("s_gaps", """
select call_id, customers, start_ms - lag(start_ms) over (partition by call_id order by start_ms, pos) as gap_ms from s_segments where speaker <> 'Employee'
""")
step("s_pattern", """
select c.call_id, contributions, coalesce(longest_ms, 0) as longest_ms, coalesce(over_45s, 0) as over_45s, coalesce(over_60s, 0) as over_60s, coalesce(over_90s, 0) as over_90s, median_gap_ms
from (select call_id, count(case when speaker <> 'Employee' then 1 end) as contributions from s_segments group by 1) c
left join (select call_id, max(stretch_ms) as longest_ms, count_if(stretch_ms > 45000) as over_45s, count_if(stretch_ms > 60000) as over_60s, count_if(stretch_ms > 90000) as over_90s from s_stretches group by 1) s on c.call_id = s.call_id
left join (select call_id, cast(floor(median(gap_ms)) as bigint) as median_gap_ms from s_gaps where gap_ms is not null group by 1) g on c.call_id = g.call_id
""")
_PATTERN = ["call_id", "contributions", "longest_ms", "over_45s", "over_60s", "over_90s", "median_gap_ms"]


@query("win_3_employee_stretches", "select call_id, cast(stretch as bigint) as stretch, from_ms, stretch_ms from s_stretches")
def win_3(t: Inputs) -> DataFrame:
    return conversation.employee_stretches(segments(t))


@query("win_4_customer_gaps", "select call_id, cast(customers as bigint) as customers, gap_ms from s_gaps where gap_ms is not null")
def win_4(t: Inputs) -> DataFrame:
    return conversation.customer_gaps(segments(t))


@query("ag_15_talk_pattern", f"select {', '.join(_PATTERN)} from s_pattern")
def ag_15(t: Inputs) -> DataFrame:
    return conversation.talk_pattern(segments(t)).select(*_PATTERN)


def spoken_sql(ms: str) -> str:
    sec = f"cast(round_even({ms} / 1000.0, 0) as bigint)"
    return (f"case when {ms} is null then 'unknown' when {sec} < 90 then concat({sec}, ' sec') when {sec} % 60 = 0 then concat({sec} // 60, ' min') "
            f"else concat({sec} // 60, ' min ', {sec} % 60, ' sec') end")


@query("str_14_pattern_words", f"""
select call_id, concat('stretches over 90 sec: ', over_90s, chr(10), 'longest unbroken stretch: ', {spoken_sql('longest_ms')}, chr(10), 'stretches over 45 sec: ', over_45s,
  '; over 60 sec: ', over_60s, chr(10), 'customer spoke ', contributions, ' time(s)',
  case when median_gap_ms is not null then concat(chr(10), 'usually about ', {spoken_sql('median_gap_ms')}, ' between contributions') else '' end) as description from s_pattern
""")
def str_14(t: Inputs) -> DataFrame:
    return conversation.describe_pattern(conversation.talk_pattern(segments(t))).select("call_id", "description")


@query("str_13_spoken_times", f"select call_id, pos, {spoken_sql('end_ms')} as spoken, {_CLOCK.format('end_ms')} as clock from v_turns_raw")
def str_13(t: Inputs) -> DataFrame:
    return t.turns_raw.select("call_id", "pos", text.spoken_duration("end_ms").alias("spoken"), text.clock("end_ms").alias("clock"))


# --- counters --------------------------------------------------------------------
@query("ag_14_metadata", f"""
select call_id, count(*) as total_turns, count_if(speaker = 'Employee') as employee_turns, count_if(speaker = 'Customer') as customer_turns,
  cast(sum(case when speaker = 'Employee' then w else 0 end) as bigint) as employee_words, cast(sum(case when speaker = 'Customer' then w else 0 end) as bigint) as customer_words,
  round(sum(case when speaker = 'Employee' then w else 0 end) / cast(sum(w) as double), 4) as talk_ratio
from (select *, {_WORDS.format('text')} as w from s_turns) x group by 1
""")
def ag_14(t: Inputs) -> DataFrame:
    return conversation.metadata(turns(t))


@query("win_5_longest_monologue", f"""
select call_id, coalesce(max(case when speaker = 'Employee' then w end), 0) as longest_monologue_words from (
  select call_id, island, any_value(speaker) as speaker, cast(sum({_WORDS.format('text')}) as bigint) as w from (
    select *, sum(changed) over (partition by call_id order by turn) as island from (
      select *, case when lag(speaker) over (partition by call_id order by turn) <> speaker then 1 else 0 end as changed from s_turns) a) b group by 1, 2) c group by 1
""")
def win_5(t: Inputs) -> DataFrame:
    return conversation.longest_monologue(turns(t))


_LINE = "concat(turn + 1, '. ', speaker, ': ', text)"


@query("win_6_context_frames", f"""
select call_id, turn, coalesce(string_agg(line, chr(10)) over (partition by call_id order by turn rows between 6 preceding and 1 preceding), '') as context_before, line as target,
  coalesce(string_agg(line, chr(10)) over (partition by call_id order by turn rows between 1 following and 3 following), '') as context_after
from (select call_id, turn, {_LINE} as line from s_turns) x
""")
def win_6(t: Inputs) -> DataFrame:
    return conversation.context_frames(turns(t)).select("call_id", "turn", "context_before", "target", "context_after")


@query("win_7_scan_targets", f"""
select call_id, count_if(e) as employee_turns, count_if(e and not b) as targets, count_if(e and b) as skipped from (
  select call_id, lower(trim(speaker)) in ('employee', 'agent', 'sales', 'counsellor') as e, {backchannel_sql('text')} as b from v_turns_raw) x group by 1
""")
def win_7(t: Inputs) -> DataFrame:
    return conversation.scan_counts(t.turns_raw)


@query("win_8_chunks", """
select call_id, s as chunk_start, count(*) as turns, min(turn) as first_turn, max(turn) as last_turn from (
  select t.call_id, t.turn, c.s from s_turns t join (
    select call_id, unnest(range(0, cast(ceil(greatest(n - 5, 0) / 3.0) as bigint) * 3 + 1, 3)) as s from (select call_id, count(*) as n from s_turns group by 1) a) c
  on t.call_id = c.call_id and t.turn >= c.s and t.turn < c.s + 5) x group by 1, 2
""")
def win_8(t: Inputs) -> DataFrame:
    """Chunks of 5 turns with an overlap of 2, as the conversations here are short."""
    placed = conversation.chunks(turns(t), size=5, overlap=2)
    return placed.groupBy("call_id", "chunk_start").agg(F.count("*").alias("turns"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))


# --- display ----------------------------------------------------------------------
step("s_timed", "select * from s_merged")
_DISPLAY = """
select c.call_id, c.turn, c.role, c.text, m.start_ms, m.end_ms from s_merged c
left join (select t.*, true as ok from s_merged t where call_id in (
  select a.call_id from (select call_id, count(*) as n from s_merged group by 1) a join (
    select call_id, count(*) as n from (select *, row_number() over (partition by call_id order by turn) as rn from s_merged) q group by 1) b on a.call_id = b.call_id
  where a.n = b.n + case when a.n % 3 = 0 then 1 else 0 end)) m on c.call_id = m.call_id and c.turn = m.turn
"""
step("s_display", _DISPLAY)


def _display(t: Inputs) -> DataFrame:
    """Calls with a turn count divisible by 3 get one utterance too many, so they do not align."""
    merged = conversation.merged_turns(cleaned(t))
    sizes = merged.groupBy("call_id").agg(F.count("*").alias("n"))
    extra = sizes.where(F.col("n") % 3 == 0).select("call_id", F.col("n").alias("turn"), F.lit(0).alias("start_ms"), F.lit(0).alias("end_ms"))
    timed = merged.select("call_id", "turn", "start_ms", "end_ms").unionByName(extra)
    return conversation.aligned_display(merged.select("call_id", "turn", "role", "text"), timed)


@query("jn_7_aligned_display", "select call_id, turn, role, start_ms, end_ms from s_display")
def jn_7(t: Inputs) -> DataFrame:
    return _display(t).select("call_id", "turn", "role", "start_ms", "end_ms")


@query("snk_7_published_document", """
select a.call_id, a.status, coalesce(d.turns, 0) as turns, d.first_text, d.last_start from (select distinct cast(conv_id as varchar) as call_id, 'audited' as status from conversations) a
left join (select call_id, count(*) as turns, min_by(text, turn) as first_text, max_by(coalesce(start_ms, -1), turn) as last_start from s_display group by 1) d on a.call_id = d.call_id
""")
def snk_7(t: Inputs) -> DataFrame:
    audits = t.conversations.select(F.col("conv_id").cast("string").alias("call_id"), F.lit("audited").alias("status")).distinct()
    nested = storage.attach_transcript(audits, _display(t).withColumnRenamed("role", "speaker"))
    return nested.select("call_id", "status", F.size("transcript").cast("bigint").alias("turns"), F.element_at("transcript", 1)["text"].alias("first_text"),
                         F.coalesce(F.element_at("transcript", -1)["start_ms"], F.lit(-1)).cast("bigint").alias("last_start"))


# --- text ---------------------------------------------------------------------------
@query("str_4_clean_text", f"select call_id, pos, {_TIDY.format('text')} as text from v_turns_raw")
def str_4(t: Inputs) -> DataFrame:
    return t.turns_raw.select("call_id", "pos", text.clean_text("text").alias("text"))


@query("str_5_sanitize", r"""
select doc_id, trim(regexp_replace(s, '\s+', ' ', 'g')) as text, s <> raw as modified
from (select doc_id, raw, regexp_replace(replace(raw, 'Ա', ''), '[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\x{ad}\x{200b}-\x{200f}\x{feff}]|[ªº]|[\p{Greek}\p{Cyrillic}\p{Han}\p{Hiragana}\p{Katakana}\p{Arabic}\p{Hangul}\p{Hebrew}\p{Thai}]', '', 'g') as s
      from (select doc_id, concat(text, ' नमस्ते ', case when lang = 'en' then 'Ա' else '' end) as raw from documents) x) y
""")
def str_5(t: Inputs) -> DataFrame:
    mixed = t.documents.select("doc_id", F.concat("text", F.lit(" नमस्ते "), F.when(F.col("lang") == "en", "Ա").otherwise("")).alias("raw"))
    return mixed.select("doc_id", text.sanitize("raw").alias("text"), text.was_sanitized("raw").alias("modified"))


@query("str_6_sanitize_nested", r"""
select page_id, trim(regexp_replace(title, '\s+', ' ', 'g')) as title, trim(regexp_replace(url, '\s+', ' ', 'g')) as url, trim(regexp_replace(concat(title, '  x'), '\s+', ' ', 'g')) as second
from (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, url from pages) x
""")
def str_6(t: Inputs) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    nested = t.pages.select("page_id", F.struct(title.alias("title"), F.array(F.struct(F.col("url").alias("url")), F.struct(F.concat(title, F.lit("  x")).alias("url"))).alias("links")).alias("d"))
    clean = transcripts.sanitize_nested(F.col("d"), nested.schema["d"].dataType)
    return nested.select("page_id", clean.alias("d")).select("page_id", "d.title", F.col("d.links")[0]["url"].alias("url"), F.col("d.links")[1]["url"].alias("second"))


_MASK = r"regexp_replace(text, '\+?[0-9][0-9\s\-]{7,}[0-9]', '[REDACTED_PHONE]', 'g')"


@query("str_7_redact_phones", f"select doc_id, {_MASK} as text, text as verbatim from documents")
def str_7(t: Inputs) -> DataFrame:
    nested = t.documents.select("doc_id", F.struct(F.col("text").alias("text"), F.col("text").alias("verbatim")).alias("d"))
    return nested.select("doc_id", transcripts.redact_nested(F.col("d"), nested.schema["d"].dataType, K.REDACTION_EXEMPT_KEYS).alias("d")).select("doc_id", "d.text", "d.verbatim")


def last_place(stop: str) -> str:
    return f"case when contains(head, '{stop}') then length(head) - (strpos(reverse(head), '{stop[::-1]}') - 1) - {len(stop)} else -1 end"


@query("str_8_shorten", f"""
select doc_id, case when length(text) <= 400 then text when a >= 200 then trim(left(head, a + 1)) when b >= 200 then trim(left(head, b + 1)) when c >= 200 then trim(left(head, c + 1))
    else left(concat(rtrim(case when s >= 200 then left(head, s) else left(head, 399) end, ' ,;:-—–'), '…'), 400) end as text, (length(text) > 400) as trimmed
from (select doc_id, text, head, {last_place('. ')} as a, {last_place('! ')} as b, {last_place('? ')} as c, {last_place(' ')} as s from (select doc_id, text, left(text, 400) as head from documents) x) y
""")
def str_8(t: Inputs) -> DataFrame:
    return t.documents.select("doc_id", text.shorten("text", 400).alias("text"), (F.length("text") > 400).alias("trimmed"))


CITE = r"(?i)\s*[(\[]?\s*(?:at|in|on|by|from|during|see|through|across|over)?\s*turns?\s+\d+(?:(?:\s*(?:,|and|&|-|–)\s*)+\d+)*\s*[)\]]?"


@query("str_9_turn_citations", rf"""
select call_id, pos, case when cut = raw then raw else concat(upper(left(tidy, 1)), substr(tidy, 2)) end as text, (cut <> raw) as stripped
from (select *, trim(regexp_replace(regexp_replace(cut, '\s{{2,}}', ' ', 'g'), '\s+([,.;:])', '\1', 'g')) as tidy
  from (select call_id, pos, raw, regexp_replace(raw, '{CITE}', ' ', 'g') as cut
    from (select call_id, pos, case when role = 'user' then text else concat('At turn ', pos, ' ', lower(text), ' (turns 3, ', pos, ' and 9), see turn 4. End.') end as raw from v_turns_raw) a) b) c
""")
def str_9(t: Inputs) -> DataFrame:
    p = F.col("pos").cast("string")
    cited = F.concat(F.lit("At turn "), p, F.lit(" "), F.lower("text"), F.lit(" (turns 3, "), p, F.lit(" and 9), see turn 4. End."))
    rows = t.turns_raw.select("call_id", "pos", F.when(F.col("role") == "user", F.col("text")).otherwise(cited).alias("raw"))
    return rows.select("call_id", "pos", text.strip_turn_citations("raw").alias("text"), (F.col("raw") != text.strip_turn_citations("raw")).alias("stripped"))


_SPLIT = r"[\s।॥,.?!;:\"''()–—-]+"


@query("str_10_words", rf"""
select call_id, pos, cast({_WORDS.format('text')} as bigint) as words,
  cast(len(list_distinct(list_filter(regexp_split_to_array(lower(text), '{_SPLIT}'), lambda w: length(w) > 2))) as bigint) as tokens from v_turns_raw
""")
def str_10(t: Inputs) -> DataFrame:
    return t.turns_raw.select("call_id", "pos", text.word_count("text").alias("words"), F.size(text.token_set("text")).cast("bigint").alias("tokens"))


step("s_rendered", """
select call_id, string_agg(concat('[', turn, '] ', speaker, ': ', text), chr(10) order by turn) as zero_based, string_agg(concat(turn + 1, '. ', speaker, ': ', text), chr(10) order by turn) as one_based from s_turns group by 1
""")


@query("str_11_token_estimate", """
select call_id, length(zero_based) as chars, cast(floor(length(zero_based) / 3.0) as bigint) as tokens, case when cast(floor(length(zero_based) / 3.0) as bigint) > 12000 then 'map_reduce' else 'single_pass' end as mode from s_rendered
""")
def str_11(t: Inputs) -> DataFrame:
    return conversation.transcript_size(turns(t))


@query("str_12_numbered_transcript", "select call_id, zero_based, one_based from s_rendered")
def str_12(t: Inputs) -> DataFrame:
    zero = conversation.numbered_transcript(turns(t)).select("call_id", F.col("transcript").alias("zero_based"))
    one = conversation.numbered_transcript(turns(t), style="one").select("call_id", F.col("transcript").alias("one_based"))
    return zero.join(one, "call_id")


@query("str_15_strip_fences", r"select doc_id, trim(text, ' ' || chr(10) || chr(9) || chr(13)) as text from documents")
def str_15(t: Inputs) -> DataFrame:
    fenced = F.concat(F.lit("```"), F.when(F.col("lang") == "en", "json").otherwise(""), F.lit("\n"), "text", F.lit("\n``` "))
    return t.documents.select("doc_id", text.strip_fences(fenced).alias("text"))
