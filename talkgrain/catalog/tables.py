"""The driver tables seen as contact-centre inputs.

Each view reads a whole table.  The SQL text is valid in Spark and in DuckDB, unless a separate
DuckDB text is given; the checks use it as a common table expression.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from talkgrain import constants as K


class View(NamedTuple):
    tables: tuple[str, ...]
    spark: str
    duck: str


def _names(values: tuple[str, ...], index: str) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {cases} end"


VIEWS: dict[str, View] = {}


def _view(name: str, tables: str, spark: str, duck: str | None = None) -> None:
    VIEWS[name] = View(tuple(tables.split()), spark.strip(), (duck or spark).strip())


_view("v_roster_file", "customer", """
select c_custkey as pos,
  case when c_acctbal < 0 then '' when c_mktsegment = 'BUILDING' then cast(c_custkey - 1 as varchar(20))
       else cast(c_custkey as varchar(20)) end as extension,
  concat(' Agent ', cast(c_custkey % 200 as varchar(20))) as name,
  concat('079', lpad(cast(case when c_mktsegment = 'FURNITURE' then c_custkey % 400 else c_custkey + 1000000 end
    as varchar(20)), 8, '0')) as did,
  concat('1028', cast(c_custkey as varchar(20))) as account_id,
  case when c_mktsegment = 'MACHINERY' then '' else concat('TL-', cast(c_nationkey as varchar(20))) end as tl,
  case when c_nationkey = 0 then '' else c_mktsegment end as state
from customer
""")

_view("v_calls", "orders", """
select cast(o_orderkey as varchar(20)) as call_id,
  case when o_orderpriority = '1-URGENT' then concat('1028', cast(o_custkey as varchar(20)))
       else cast(o_custkey as varchar(20)) end as agent_extension,
  case when o_orderpriority = '5-LOW' then '' else concat('Agent ', cast(o_custkey % 200 as varchar(20))) end as agent_name,
  concat('079', lpad(cast(o_custkey + 1000000 as varchar(20)), 8, '0')) as agent_did,
  o_orderdate + interval '1' second * cast((o_orderkey * 7919) % 86400 as int) as started_at,
  cast((o_orderkey * 7919) % 1800 as bigint) as duration_sec,
  case when o_orderstatus = 'F' then 'PROCESSED' when o_orderstatus = 'O' then 'UNPROCESSED'
       when o_orderpriority = '1-URGENT' then 'INGESTING' when o_orderpriority = '2-HIGH' then 'AUDITING'
       when o_orderpriority = '3-MEDIUM' then 'DISCARDED' else 'FAILED' end as processing_status,
  case when o_orderstatus <> 'F' or o_orderkey % 37 = 0 then null
       else 55 + ((o_orderkey * 7919) % 400) / 10.0e0 end as score,
  case when o_orderstatus = 'F' then cast(o_orderkey % 4 as bigint) end as flag_count,
  case when o_orderstatus = 'F' and o_orderkey % 4 = 1 then 'LOW' when o_orderstatus = 'F' and o_orderkey % 4 = 2 then 'MEDIUM'
       when o_orderstatus = 'F' and o_orderkey % 4 = 3 then 'HIGH' end as audit_status,
  (o_orderstatus = 'F' and o_orderkey % 37 = 0) as disqualified,
  case when o_orderpriority = '1-URGENT' and o_orderkey % 2 = 0 then null
       else o_orderdate + interval '1' day end as status_at,
  concat('9', lpad(cast(o_orderkey as varchar(20)), 9, '0')) as customer_phone,
  case when o_orderkey % 3 = 0 then 'INBOUND' else 'OUTBOUND' end as call_direction,
  cast(null as varchar(20)) as failure_reason
from orders
""")

_LOG = """
  select case when value < 0.05e0 then '' else concat(' ', cast(event_id as varchar(20))) end as callid,
    concat('tok', cast(event_id as varchar(20))) as unique_token,
    case when event_type in ('view', 'purchase') then 'Inbound' else 'OUTBOUND' end as call_direction,
    case when event_type in ('view', 'purchase') then concat('+91', cast(9000000000 + event_id as varchar(20)))
         else cast(user_id as varchar(20)) end as caller,
    case when event_type in ('view', 'purchase') then null else cast(user_id as varchar(20)) end as caller_name,
    case when event_type in ('view', 'purchase') then cast(user_id as varchar(20))
         else concat('0', cast(8000000000 + event_id as varchar(20))) end as callee,
    case when event_type in ('view', 'purchase') then concat('Person ', cast(user_id as varchar(20))) else '' end as callee_name,
    case when event_type in ('view', 'purchase') then '' when event_type = 'error' then 'N/A'
         else concat('079', lpad(cast(user_id + 1000000 as varchar(20)), 8, '0')) end as outbound_caller_id,
    case when event_type = 'view' then concat('+91 79', lpad(cast(user_id + 1000000 as varchar(20)), 8, '0'))
         when event_type = 'error' then concat('079', lpad(cast(user_id as varchar(20)), 8, '0')) else 'N/A' end as did,
    case when value < 1.0e0 then 'unreadable' else substr(cast(ts as varchar(40)), 1, 19) end as start_date,
    substr(cast(ts as varchar(40)), 1, 19) as answer_time, substr(cast(ts as varchar(40)), 1, 19) as end_date,
    case event_type when 'error' then 'n/a' when 'signup' then concat(' ', cast(cast(floor(value) as bigint) as varchar(20)), ' ')
         else cast(cast(floor(value) as bigint) as varchar(20)) end as call_sec,
    cast(value as varchar(20)) as answer_sec,
    case event_type when 'click' then 'ANSWERED' when 'view' then 'answered' when 'purchase' then 'Answered'
         when 'signup' then '' else 'NOANSWER' end as call_status,
    'agent' as hangup_by, props as hangup_reason,
    case cast(floor(value) as bigint) % 5 when 0 then '-' when 1 then 'N/A' when 2 then concat('ftp://rec/', cast(event_id as varchar(20)))
         else concat('https://rec/', cast(event_id as varchar(20)), '.wav') end as call_rec_path,
    ts as start_ts
"""
_view("v_log_raw", "events", f"""
select x.*, 0 as arrival from ({_LOG} from events) x
union all select x.*, 1 as arrival from ({_LOG} from events where event_type = 'error') x
""")

_view("v_known", "events", "select cast(event_id as varchar(20)) as callid from events where event_id % 4 = 0")

_view("v_turns_raw", "conversations", """
select cast(conv_id as varchar(20)) as call_id, turn as pos, role,
  case when role = 'user' then case when length(text) % 3 = 0 then 'Agent' else 'student' end
       when role = 'assistant' then case when length(text) % 5 = 0 then 'Customer' else ' employee ' end
       else 'Narrator' end as speaker, text,
  turn * 40000 as start_ms, turn * 40000 + length(text) * 60 as end_ms
from conversations
""")

_view("v_tokens", "conversations", """
with w as (select conv_id, turn, role, posexplode(split(text, ' ')) as (idx, word) from conversations)
select cast(conv_id as varchar(20)) as call_id, turn * 200000 + idx * 2 as pos, word as text,
  case role when 'user' then 'S1' when 'assistant' then 'S2' else 'S3' end as speaker,
  case when length(word) = 11 then null else turn * 1000000 + idx * 400 end as start_ms,
  case when length(word) % 7 = 0 then null else turn * 1000000 + idx * 400 + length(word) * 60 end as end_ms
from w
union all
select cast(conv_id as varchar(20)), turn * 200000 + idx * 2 + 1, ' ', 'S1', cast(null as bigint), cast(null as bigint) from w
""", """
select cast(conv_id as varchar(20)) as call_id, turn * 200000 + idx * 2 as pos, word as text,
  case role when 'user' then 'S1' when 'assistant' then 'S2' else 'S3' end as speaker,
  case when length(word) = 11 then null else turn * 1000000 + idx * 400 end as start_ms,
  case when length(word) % 7 = 0 then null else turn * 1000000 + idx * 400 + length(word) * 60 end as end_ms
from (select conv_id, turn, role, unnest(string_split(text, ' ')) as word,
        generate_subscripts(string_split(text, ' '), 1) - 1 as idx from conversations) w
union all
select cast(conv_id as varchar(20)), turn * 200000 + idx * 2 + 1, ' ', 'S1', null, null
from (select conv_id, turn, role, generate_subscripts(string_split(text, ' '), 1) - 1 as idx from conversations) w
""")

_PHRASE = "concat({0}(text, ' ', 2), ' ', {0}(text, ' ', 3), ' ', {0}(text, ' ', 4))".format("split_part")
_CATEGORY = _names(("rude", "Pressure ", "abusive", "casteist_remark", "overpromise", "brand new thing",
                    "insult_or_mockery"), "cast(length(text) % 7 as int)")

_view("v_verdicts", "conversations", f"""
select cast(conv_id as varchar(20)) as call_id, turn, (length(text) % 2 = 0) as flagged,
  case when length(text) % 3 = 0 then '' else {_PHRASE} end as phrase,
  case when length(text) % 5 = 0 then '' else {_CATEGORY} end as category,
  case when length(text) % 4 = 0 then null else {_names(('low', 'medium', 'high', 'low'), 'cast(length(text) % 4 as int)')} end as severity,
  case when role = 'user' then null else role end as reason
from conversations
""")

_view("v_upstream", "conversations", f"""
select cast(conv_id as varchar(20)) as call_id, turn as seq,
  case when length(text) % 4 = 0 then turn when length(text) % 4 = 1 then turn + 1 when length(text) % 4 = 2 then turn + 3
       else null end as stated,
  case when length(text) % 6 = 0 then '' when role = 'assistant' and length(text) % 5 <> 0 then 'employee' else 'CUSTOMER' end as speaker,
  case when length(text) % 9 = 0 then 'words nobody said' when length(text) % 2 = 0 then split_part(text, ' ', 3) else {_PHRASE} end as phrase,
  {_CATEGORY} as category,
  case when length(text) % 8 = 0 then 'critical' else {_names(('low', 'MEDIUM', 'high'), 'cast(length(text) % 3 as int)')} end as severity,
  case when length(text) % 3 = 0 then '' else 'heard upstream' end as reason,
  case when length(text) % 2 = 0 then 'conduct_scan' else 'whole_call' end as source,
  case when length(text) % 3 = 1 then turn + 2 end as also_at
from conversations
""")

_view("v_report_flags", "conversations", f"""
select cast(conv_id as varchar(20)) as call_id, turn as seq,
  {_names(K.FLAG_TYPES, 'cast(length(text) % 5 as int)')} as flag_type,
  {_names(K.SEVERITIES, 'cast(length(text) % 3 as int)')} as severity,
  case when length(text) % 7 = 0 then '' else {_PHRASE} end as verbatim,
  case when length(text) % 4 = 0 then turn + 1 when length(text) % 4 = 1 then turn - 1 else turn end as turn_index,
  1 + length(text) % 2 as occurrences,
  case when length(text) % 3 = 0 then turn + 2 end as also_at, 'audit' as source,
  case when length(text) % 2 = 0 then 'said in anger' else 'pressed twice' end as why_flagged
from conversations where role = 'assistant'
""")

_view("v_objections", "conversations", f"""
select cast(conv_id as varchar(20)) as call_id, turn as objection_id, text as verbatim, turn as turn_index,
  case when length(text) % 3 = 0 then turn - 2 end as repeated_at,
  case when length(text) % 10 = 0 then 'weather' else {_names(K.ENUMS['objection_type'], 'cast(length(text) % 10 as int)')} end as objection_type
from conversations where role = 'user'
""")

# Some quote what the customer said two turns before: an earlier surfacing that is not linked.
_view("v_quoted_objections", "conversations", """
select call_id, objection_id, objection_type, case when length(verbatim) % 4 = 0 then coalesce(earlier, verbatim) else verbatim end as verbatim, turn_index, repeated_at
from (
  select cast(conv_id as varchar(20)) as call_id, turn as objection_id, text as verbatim, turn as turn_index, 'price' as objection_type,
    lag(text) over (partition by conv_id order by turn) as earlier, case when length(text) % 8 = 0 then turn - 2 end as repeated_at
  from conversations where role = 'user') x
""")

_view("v_dismissed", "conversations",
      "select cast(conv_id as varchar(20)) as call_id, turn from conversations where role = 'system'")

_view("v_usage", "events", """
select event_id as call_id, user_id,
  case event_type when 'click' then 'gpt-5.4-mini-2026-04-01' when 'view' then 'gpt-5.6-luna' when 'error' then 'unlisted-model'
    when 'signup' then 'gpt-5-mini' else 'gpt-5.4' end as model,
  case when event_type in ('click', 'view') then 'audit' else 'analyse' end as stage,
  cast(floor(value * 100) as bigint) as prompt_tokens, cast(floor(value * 60) as bigint) as cached_tokens,
  cast(floor(value * 10) as bigint) as completion_tokens, cast(floor(value * 3) as bigint) as reasoning_tokens,
  cast(event_id % 50 as bigint) as cache_write_tokens, ts
from events
""")

_MARK_NAMES = _names(("", *K.CRITERIA[:7]), "l_linenumber")
_view("v_marks", "lineitem", f"""
select call_id, criterion, max(awarded) as awarded
from (select cast(l_orderkey as varchar(20)) as call_id, {_MARK_NAMES} as criterion,
        cast(cast(l_quantity as bigint) % 11 as bigint) as awarded from lineitem) m
group by call_id, criterion
""")

_CARD = """
select cast(o_orderkey as varchar(20)) as call_id, {name} as criterion,
  cast((o_orderkey * (j * 7 + 3) + j) % 12 as bigint) as awarded, ((o_orderkey + j) % 4 <> 0) as reached,
  {justification} as justification
from {source} c
"""
_JUST = "case when o_orderkey % 2 = 0 then 'went back to it later' else 'said plainly' end"
_view("v_card", "orders",
      _CARD.format(name=_names(K.CRITERIA, "j"), justification=_JUST,
                   source="(select o_orderkey, explode(sequence(0, 8)) as j from orders)"),
      _CARD.format(name=_names(K.CRITERIA, "j"), justification=_JUST,
                   source="(select o_orderkey, unnest(range(0, 9)) as j from orders)"))

_STATE = "case when o_orderpriority = '5-LOW' then 'not_reached' else {} end"
_view("v_flows", "orders", f"""
select cast(o_orderkey as varchar(20)) as call_id,
  {_STATE.format(_names(K.ENUMS['flow_checkpoint'], 'cast(o_orderkey % 3 as int)'))} as introduction_first,
  {_STATE.format(_names(K.ENUMS['flow_checkpoint'], 'cast((o_orderkey + o_custkey) % 3 as int)'))} as qualification_block,
  {_STATE.format(_names(K.ENUMS['flow_checkpoint'], 'cast(o_custkey % 3 as int)'))} as personalised_path_block,
  {_JUST} as justification
from orders
""")

_view("v_repeats", "lineitem", f"""
select cast(l_orderkey as varchar(20)) as call_id, {_names(K.CRITERIA, 'cast((l_linenumber + l_suppkey) % 9 as int)')} as criterion
from lineitem
""")

_view("v_continuity", "orders", """
select cast(o_orderkey as varchar(20)) as call_id, cast(o_custkey as varchar(20)) as parent_id,
  (o_orderpriority in ('1-URGENT', '2-HIGH')) as is_follow_up,
  case when o_orderpriority = '1-URGENT' then 'she mentions the link sent yesterday' end as basis
from orders
""")

_view("v_relevance", "orders", """
select cast(o_orderkey as varchar(20)) as call_id, (o_orderstatus <> 'P') as is_relevant from orders
""")

_view("v_call_flags", "lineitem", """
select cast(l_orderkey as varchar(20)) as call_id,
  case when l_returnflag = 'A' and l_linenumber = 7 then 'abusive_language'
       when l_returnflag = 'R' and l_linenumber = 1 then 'discriminatory_remark'
       when l_linestatus = 'O' then 'coercive_pressure' else 'other_misconduct' end as flag_type
from lineitem
""")

_N, _T = "cast(length(text) as int)", "cast(turn as varchar(20))"
_W = "concat(split_part(replace(text, chr(10), ' '), ' ', 2), '_', cast(length(text) % 97 as varchar(20)))"
_LONG = "repeat(concat('{} ', " + _W + ", '. '), cast(1 + length(text) % {} as int))"
_PICK = lambda values, base: _names(values, f"cast(length(text) % {base} as int)")
_CLAIMS = "concat('{\"text\":\"', " + _W + ", '\",\"evidence_turns\":[', " + _T + ", ',', cast(length(text) % 9 as varchar(20)), ']}')"
_QUOTE = "concat('{\"verbatim\":\"', " + _W + ", '\",\"turn_index\":', cast(length(text) % 8 - 1 as varchar(20)), '}')"


def _json(**fields: str) -> str:
    """SQL that writes a JSON object; values are SQL texts of JSON."""
    parts = [f"'\"{name}\":', {value}" for name, value in fields.items()]
    return "concat('{', " + ", ',', ".join(parts) + ", '}')"


def _quote(sql: str) -> str:
    return f"concat('\"', {sql}, '\"')"


def _some(item: str, most: int) -> str:
    """A list of 0 to most - 1 equal items."""
    return f"concat('[', case when length(text) % {most} > 0 then concat({item}, repeat(concat(',', {item}), cast(length(text) % {most} - 1 as int))) else '' end, ']')"


_REPORT = _json(
    call_purpose=_CLAIMS,
    customer_profile=_json(attempts_given="cast(length(text) % 4 - 1 as varchar(20))", decision_maker=_quote(_PICK(("self", "parent", "both", "uncle"), 4)), evidence_turns="'[]'", pet="'\"cat\"'"),
    lead_relevance=_json(is_relevant="case when length(text) % 4 = 0 then 'false' else 'true' end", reason=_quote(_LONG.format("never a buyer", 60)), evidence_turns="'null'"),
    call_continuity=_json(
        is_follow_up="case when length(text) % 3 = 0 then 'true' else 'false' end", basis="'null'",
        repeated_from_previous=_some(_json(criterion="'\"purpose_of_call\"'", what=_quote(_LONG.format("again", 40)), already_covered="'\"fees\"'", evidence_turns=f"concat('[', {_T}, ']')"), 14)),
    discovery_quality=_json(questions_asked=_some(_quote(_LONG.format("asked which class", 40)), 15), evidence_turns="'[3]'"),
    timeline=_some(_json(phase=_quote(_PICK(("opening", "coffee", "pitch"), 3)), start_turn="cast(length(text) % 6 - 1 as varchar(20))", end_turn=_T, mood="'{\"is\":[1]}'"), 3),
    objections=_some(_json(
        objection_type=_quote(_PICK(("price", "weather", "other"), 3)), quote=_QUOTE, repeated_at_turns=f"concat('[', {_T}, ',2]')", response_turn_indices="'[1,null,40]'",
        handling_quality=_quote(_PICK(("ignored", "deflected", "laughed"), 3))), 3),
    outcome_block=_json(
        outcome=_quote(_PICK(("demo_agreed", "wrong_number", "eloped"), 3)), outcome_evidence_turns=f"concat('[', {_T}, ']')",
        next_step=_json(action="'null'", evidence_turns="'[7]'", more="'{\"deep\":{\"er\":1}}'"), conversion_probability="case when length(text) % 5 = 0 then '1.5' else concat('0.', cast(length(text) % 5 as varchar(20))) end"),
    scorecard=_json(
        purpose_of_call=_json(reached="'true'", awarded="cast(length(text) % 13 - 1 as varchar(20))", justification=_quote(_LONG.format("said plainly at turn 3", 60)), evidence_turns=f"concat('[', {_T}, ']')"),
        pitch_flow_order=_json(reached="'true'", awarded="'5'", introduction_first=_quote(_PICK(("held", "broken", "bent"), 3)), qualification_block="'\"held\"'"), humour="'{\"awarded\":10}'"),
    compliance_flags=_some(_json(
        flag_type=_quote(_PICK(("abusive_language", "yelling"), 2)), severity=_quote(_PICK(("low", "grave"), 2)), quote=_QUOTE, why_flagged="'\"at turn 4\"'",
        occurrences="cast(length(text) % 3 as varchar(20))", occurrence_turns=f"concat('[', {_T}, ',-2]')"), 3),
    coaching=_json(strengths=_some(_CLAIMS, 6), coaching_actions=_some(_json(action="'\"slow down\"'", criterion="'\"purpose_of_call\"'", evidence_turns="'[2]'"), 7), best_line="'null'", worst_line=_QUOTE),
    sales_summary=_json(
        auditor_note=_quote(_LONG.format("He was told in turns 3, 4 and 9 that", 30)), snapshot_points=_some(_quote(_LONG.format("paid at turn 5", 40)), 8), call_tone="'\"warm\"'",
        call_in_brief=_quote(f"concat('At turn ', {_T}, ' ', {_W}, ' rang (turn 2), and left.')"), conversion_reasons=_some(_quote("'said yes, see turn 8'"), 6),
        improvements=_some(_json(title=_quote("'Ask first'"), detail=_quote(_LONG.format("By turn 12 ask", 50))), 6), bottom_line=_quote(_LONG.format("stop", 300)),
        carry_forward=_json(student_details=_some(_quote("concat('class ', " + _T + ")"), 12), open_threads=_some(_quote(_LONG.format("call back from turn 9", 30)), 10))),
    sentiment_layer_agreement=_json(agrees="'true'", dismissed_turns="'[1]'"),
    turn_range=f"concat('[', {_T}, ',', cast(length(text) % 50 as varchar(20)), case when length(text) % 3 = 0 then ',1' else '' end, ']')")

# A report for each turn, with keys, values, sizes and citations that the schema allows and others that it does not.
_view("v_report", "conversations", f"""
select concat(cast(conv_id as varchar(20)), '-', cast(turn as varchar(20))) as call_id, cast(conv_id as varchar(20)) as of_call, turn, {_REPORT} as body
from conversations
""")


class Inputs:
    """Driver tables and their views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str, **rows: DataFrame) -> DataFrame:
        """A view, over ``rows`` of a table where given."""
        view = VIEWS[name]
        for table in view.tables:
            rows.get(table, self.table(table)).createOrReplaceTempView(table)
        return self.spark.sql(view.spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        return self.view("v_" + name) if "v_" + name in VIEWS else self.table(name)
