"""The chain of steps on one call where every step has something to do."""

import pytest

from talkgrain.operators import chain, report

TURNS = [("Employee", "Hello from the desk"), ("Customer", "The fees are really quite high"), ("Employee", "Listen to me you fool"), ("Customer", "I said the fees are high"), ("Employee", "You will regret this choice"), ("Customer", "bye")]
BODY = """{"call_purpose": {"text": "fees", "evidence_turns": [1, 9]}, "timeline": [{"phase": "pitch", "start_turn": 0, "end_turn": 5}],
"sales_summary": {"call_in_brief": "At turn 2 he shouted.", "improvements": [{"title": "Listen", "detail": "see turns 2 and 4"}], "carry_forward": {"open_threads": []}}}"""


@pytest.fixture(scope="module")
def done(spark):
    turns = spark.createDataFrame([("c", k, *t) for k, t in enumerate(TURNS)] + [("d", 0, "Employee", "hello")], "call_id string, turn long, speaker string, text string")
    flags = spark.createDataFrame(
        [("c", 0, "abusive_language", "low", "you fool", 3, 1, [3], "rude", "audit"), ("c", 1, "abusive_language", "high", "Listen to me", 2, 1, [2, 4], "again", "audit")],
        "call_id string, seq long, flag_type string, severity string, verbatim string, turn_index long, occurrences long, occurrence_turns array<long>, why_flagged string, source string")
    objections = spark.createDataFrame([("c", 7, "price", "I said the fees are high", 3, [])], "call_id string, objection_id long, objection_type string, verbatim string, turn_index long, repeated_at_turns array<long>")
    upstream = spark.createDataFrame(
        [("c", 0, 5, "Employee", "regret this", "threat", "HIGH", "", "whole_call", []), ("c", 1, 9, "Employee", "never said", "rude", "low", "x", "whole_call", []),
         ("c", 2, 2, "Employee", "you fool", "rude", "low", "x", "whole_call", []), ("c", 3, 1, "Employee", "Hello", "overpromise", "low", "x", "whole_call", []),
         ("d", 0, 0, "Employee", "hello", "rude", "low", "x", "whole_call", [])],
        "call_id string, seq long, stated long, speaker string, phrase string, category string, severity string, reason string, source string, also_at_turns array<long>")
    dismissed = spark.createDataFrame([("d", 0)], "call_id string, turn long")
    documents = report.read_reports(spark.createDataFrame([("c", BODY), ("d", '{"sales_summary": {"carry_forward": {"open_threads": ["call back"]}}}')], "call_id string, body string"))
    continuity = spark.createDataFrame([("c", "p", False, None), ("d", "q", False, None)], "call_id string, parent_id string, is_follow_up boolean, basis string")
    relevance = spark.createDataFrame([("c", True), ("d", False)], "call_id string, is_relevant boolean")
    card = spark.createDataFrame([(x, name, 5, True, "fine") for x in "cd" for name in chain.schemas.SCORECARD.fieldNames()], "call_id string, criterion string, awarded long, reached boolean, justification string")
    flows = spark.createDataFrame([(x, "held", "held", "held", "in order") for x in "cd"], "call_id string, introduction_first string, qualification_block string, personalised_path_block string, justification string")
    repeats = spark.createDataFrame([("c", "purpose_of_call"), ("d", "purpose_of_call")], "call_id string, criterion string")
    parents = spark.createDataFrame([("p",)], "call_id string")
    reports, log = chain.run(chain.Reports(flags, objections, documents, continuity, relevance, card, flows, repeats), chain.Evidence(turns, upstream, dismissed, parents))
    scores, marking = chain.scored(reports)
    rows = lambda df: [r.asDict(recursive=True) for r in df.collect()]
    return {"flags": rows(reports.flags), "documents": rows(reports.documents), "continuity": rows(reports.continuity), "log": rows(log), "scores": rows(scores), "marking": rows(marking)}


def test_final_flags(done):
    got = sorted((f["call_id"], f["seq"], f["flag_type"], f["severity"], f["verbatim"], f["turn_index"], f["occurrence_turns"], f["why_flagged"], f["source"]) for f in done["flags"])
    assert got == [
        ("c", 0, "abusive_language", "high", "you fool", 2, [2, 4], "rude", "audit"),  # re-anchored, then one with the flag that shares its turn
        ("c", 3, "disrespectful_conduct", "low", "never said", 0, [0], "x", "sentiment_layer")]  # carried; it covers turn 0 for the one after it


def test_log_names_what_each_step_did(done):
    told = {(e["call_id"], e["step"], e["code"], e["subject"], e["at"]) for e in done["log"]}
    assert {
        ("c", "reanchor", "moved", "0", 2), ("c", "carry_over", "found_elsewhere", "0", 4), ("c", "carry_over", "unanchored", "1", 0), ("c", "carry_over", "found_elsewhere", "3", 0),
        ("d", "carry_over", "dismissed", "0", 0), ("c", "dedupe", "merged", "0", 2),
        ("c", "scrub", "citation_stripped", "sales_summary.call_in_brief", None), ("c", "scrub", "citation_stripped", "sales_summary.improvements[0].detail", None),
        ("c", "check_ledger", "empty_ledger", None, None), ("c", "check_repeats", "unlinked_repeat", "7", 1), ("c", "check_bounds", "outside_transcript", None, 9),
        ("c", "force_follow_up", "forced", "p", None)} <= told
    assert {e[0] for e in told if e[1] in ("scrub", "check_ledger", "force_follow_up")} == {"c"}


def test_documents_and_continuity(done):
    doc = {d["call_id"]: d["report"] for d in done["documents"]}["c"]
    assert doc["sales_summary"]["call_in_brief"] == "He shouted." and doc["sales_summary"]["improvements"][0]["detail"] == ""
    assert doc["call_purpose"]["evidence_turns"] == [1, 9]
    assert {c["call_id"]: c["is_follow_up"] for c in done["continuity"]} == {"c": True, "d": False}


def test_scores_see_the_final_reports(done):
    score = {s["call_id"]: s for s in done["scores"]}
    assert score["c"]["disqualified"] and score["c"]["overall_score_100"] == 0 and score["c"]["repetition_deductions"] > 0
    assert score["d"]["flag_count"] == 0 and score["d"]["irrelevant_lead"]
    codes = {(e["call_id"], e["code"]) for e in done["marking"]}
    assert {("c", "score_voided"), ("c", "repeat_deducted"), ("d", "repeats_without_follow_up"), ("d", "irrelevant_lead")} <= codes


def test_steps_in_order():
    assert [s.__name__ for s in chain.STEPS] == ["reanchor", "carry_over", "dedupe", "scrub", "check_ledger", "check_repeats", "check_bounds", "force_follow_up"]
