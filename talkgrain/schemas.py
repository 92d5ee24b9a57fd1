"""Declared schemas of the inputs; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from talkgrain import constants as K

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CALL_LOG = T.StructType([T.StructField(n, _S) for n in K.CALL_LOG_TEXT_FIELDS + K.CALL_LOG_INT_FIELDS])

ROSTER_ENTRY = _struct(extension=_S, name=_S, did=_S, accountId=_S, tl=_S, state=_S)
ROSTER_FILE = _struct(agents=T.ArrayType(ROSTER_ENTRY))

TOKEN = _struct(call_id=_S, pos=_L, text=_S, speaker=_S, start_ms=_L, end_ms=_L)

UTTERANCE = _struct(speaker=_S, text=_S, statement=_S, start_ms=_L, end_ms=_L)
DETAILED_TURNS = T.ArrayType(UTTERANCE)
DETAILED_DOCUMENT = _struct(transcript=DETAILED_TURNS, audio_duration_ms=_L, model=_S)
ROLE_TURNS = T.ArrayType(T.MapType(_S, _S))

UPSTREAM_FLAG = _struct(turn=_L, speaker=_S, phrase=_S, category=_S, severity=_S, reason=_S,
                        source=_S, also_at_turns=T.ArrayType(_L))
SENTIMENT = _struct(
    overall_sentiment=_S, sentiment_score=_D, call_tone_summary=_S, employee_tone=_S,
    customer_tone=_S, tone_progression=_S, customer_interest_level=_S,
    inappropriate_language_found=_B, flagged_phrases=T.ArrayType(UPSTREAM_FLAG), notes=_S)
ANALYSIS_DOCUMENT = T.StructType(SENTIMENT.fields + [T.StructField("analysis", SENTIMENT)])

QUOTE = _struct(verbatim=_S, gloss_en=_S, turn_index=_L)
_TURNS, _LINES = T.ArrayType(_L), T.ArrayType(_S)
CLAIM = _struct(text=_S, evidence_turns=_TURNS)
PROFILE = _struct(
    first_name=_S, class_or_status=_S, attempts_given=_L, is_dropper=_B, target_exam=_S, target_exam_year=_L, current_platform=_S,
    price_paid_elsewhere=_S, decision_maker=_S, location=_S, evidence_turns=_TURNS, not_established=_LINES)
RELEVANCE = _struct(is_relevant=_B, reason=_S, evidence_turns=_TURNS)
REPEAT = _struct(criterion=_S, what=_S, already_covered=_S, evidence_turns=_TURNS)
CONTINUITY = _struct(is_follow_up=_B, basis=_S, repeated_from_previous=T.ArrayType(REPEAT), evidence_turns=_TURNS)
DISCOVERY = _struct(established_need_before_pitching=_B, questions_asked=_LINES, questions_not_asked=_LINES, assessment=_S, evidence_turns=_TURNS)
PITCH = _struct(features_claimed=_LINES, pricing_claimed=_S, faculty_claimed=_LINES, guarantees_claimed=_LINES, summary=_S, evidence_turns=_TURNS)
PHASE = _struct(phase=_S, start_turn=_L, end_turn=_L, summary=_S)
OBJECTION = _struct(objection_type=_S, quote=QUOTE, repeated_at_turns=_TURNS, employee_response_summary=_S, response_turn_indices=_TURNS,
                    handling_quality=_S, resolved=_B, what_should_have_been_asked=_S)
NEXT_STEP = _struct(action=_S, owner=_S, scheduled_for=_S, is_specific=_B, evidence_turns=_TURNS)
OUTCOME = _struct(outcome=_S, outcome_reasoning=_S, outcome_evidence_turns=_TURNS, next_step=NEXT_STEP, conversion_probability=_D, probability_drivers=_LINES)
CRITERION = _struct(reached=_B, awarded=_L, justification=_S, evidence_turns=_TURNS)
FLOW_CRITERION = T.StructType(CRITERION.fields + [T.StructField(n, _S) for n in K.FLOW_BREAK_TEXT])
SCORECARD = _struct(**{name: FLOW_CRITERION if name == K.FLOW_CRITERION else CRITERION for name in K.CRITERIA})
REPORT_FLAG = _struct(flag_type=_S, severity=_S, quote=QUOTE, why_flagged=_S, occurrences=_L,
                      occurrence_turns=_TURNS, source=_S)
COACHING_ACTION = _struct(action=_S, criterion=_S, evidence_turns=_TURNS)
COACHING = _struct(strengths=T.ArrayType(CLAIM), missed_opportunities=T.ArrayType(CLAIM), coaching_actions=T.ArrayType(COACHING_ACTION), best_line=QUOTE, worst_line=QUOTE)
CARRY_FORWARD = _struct(
    student_details=_LINES, questions_asked=_LINES, information_given=_LINES, student_questions=_LINES, open_threads=_LINES)
IMPROVEMENT = _struct(title=_S, detail=_S)
SALES_SUMMARY = _struct(
    auditor_note=_S, snapshot_points=_LINES, call_tone=_S, call_in_brief=_S, primary_blocker=_S, conversion_reasons=_LINES,
    improvements=T.ArrayType(IMPROVEMENT), bottom_line=_S, what_happened=_S, conversion_status=_S, how_to_improve=_S, carry_forward=CARRY_FORWARD)
AGREEMENT = _struct(agrees=_B, notes=_S, dismissed_turns=_TURNS)
REPORT = _struct(
    call_purpose=CLAIM, customer_profile=PROFILE, lead_relevance=RELEVANCE, call_continuity=CONTINUITY, discovery_quality=DISCOVERY, pitch_summary=PITCH,
    timeline=T.ArrayType(PHASE), objections=T.ArrayType(OBJECTION), outcome_block=OUTCOME, scorecard=SCORECARD,
    compliance_flags=T.ArrayType(REPORT_FLAG), coaching=COACHING, sales_summary=SALES_SUMMARY, sentiment_layer_agreement=AGREEMENT)
CHUNK = _struct(
    turn_range=_TURNS, phases_present=_LINES, profile_facts=T.ArrayType(CLAIM), questions_asked=T.ArrayType(CLAIM), objections_raised=T.ArrayType(QUOTE),
    employee_responses=T.ArrayType(CLAIM), pitch_claims=T.ArrayType(CLAIM), compliance_candidates=T.ArrayType(QUOTE), notable_quotes=T.ArrayType(QUOTE), chunk_summary=_S)
SCORES = _struct(overall_score_100=_D, flag_count=_L, disqualified=_B,
                 criterion_marks=T.MapType(_S, _L))
AUDIT_DOCUMENT = _struct(call_id=_S, scores=SCORES, report=REPORT)

USAGE = _struct(
    prompt_tokens=_L, completion_tokens=_L,
    prompt_tokens_details=_struct(cached_tokens=_L, cache_creation_tokens=_L, cache_write_tokens=_L,
                                  cache_creation_input_tokens=_L),
    completion_tokens_details=_struct(reasoning_tokens=_L),
    cache_creation_input_tokens=_L)
