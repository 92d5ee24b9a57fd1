"""Walks over nested reports against walks in plain Python."""

import json

import pytest
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.operators import quality, report

LONG = "One sentence that is said. " * 40
DOC = {
    "call_purpose": {"text": "asked", "evidence_turns": [3, 99], "stray": {"turn_index": 5}},
    "customer_profile": None,
    "lead_relevance": {"is_relevant": True, "reason": LONG * 2, "evidence_turns": [None, 4]},
    "discovery_quality": {"questions_asked": ["q" * 900], "assessment": "fine", "evidence_turns": []},
    "timeline": [{"phase": "pitch", "start_turn": -1, "end_turn": 7, "mood": 1}, None, {"phase": "coffee", "start_turn": 0, "end_turn": 60}],
    "objections": [{"objection_type": "price", "quote": {"verbatim": "too dear", "turn_index": 12, "x": None}, "repeated_at_turns": [2], "response_turn_indices": [13, 14]}],
    "scorecard": {"purpose_of_call": {"reached": True, "awarded": 11, "justification": "j" * 801, "evidence_turns": [1]}, "charm": {"awarded": 3}},
    "compliance_flags": [{"severity": "grave", "quote": {"turn_index": -1}, "occurrences": 0, "occurrence_turns": [50]}],
    "sales_summary": {
        "call_in_brief": "At turn 3, she said no (turns 4 and 5), twice.", "snapshot_points": ["plain", "paid at turn 9", "x" * 500], "improvements": [{"title": "see turn 2", "detail": "d"}],
        "bottom_line": "no reference", "carry_forward": {"open_threads": ["call back from turn 8"], "questions_asked": ["w " * 300]}},
    "turn_index": 4,
}
ODD = ["[1, 2]", "5", "null", "{bad", "", None, "{}", '{"timeline": 7, "objections": {"a": 1}, "scorecard": [1], "call_purpose": {"text": {"a": 1}}}']


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(f"o{k}", x) for k, x in enumerate(ODD)] + [("d", json.dumps(DOC))], "call_id string, body string")


@pytest.fixture(scope="module")
def typed(documents):
    return report.read_reports(documents)


def test_citations(typed):
    rows = report.citations(typed).collect()
    assert {r["call_id"] for r in rows} == {"d"}
    assert {(r["path"], r["turn"]) for r in rows} == {
        ("call_purpose.evidence_turns[0]", 3), ("call_purpose.evidence_turns[1]", 99), ("lead_relevance.evidence_turns[1]", 4), ("timeline[0].start_turn", -1), ("timeline[0].end_turn", 7),
        ("timeline[2].start_turn", 0), ("timeline[2].end_turn", 60), ("objections[0].quote.turn_index", 12), ("objections[0].repeated_at_turns[0]", 2), ("objections[0].response_turn_indices[0]", 13),
        ("objections[0].response_turn_indices[1]", 14), ("scorecard.purpose_of_call.evidence_turns[0]", 1), ("compliance_flags[0].quote.turn_index", -1), ("compliance_flags[0].occurrence_turns[0]", 50)}
    assert {r["field"] for r in rows} <= set(K.CITATION_FIELDS)


def test_chunks_cite_turn_ranges(spark):
    chunk = spark.createDataFrame([("c", '{"turn_range": [3, 70], "notable_quotes": [{"turn_index": 8}]}')], "call_id string, body string").withColumn("report", F.from_json("body", schemas.CHUNK))
    assert sorted((r["field"], r["turn"]) for r in report.citations(chunk, kind=schemas.CHUNK).collect()) == [("turn_index", 8), ("turn_range", 3), ("turn_range", 70)]


def test_every_citation_field_is_in_a_schema():
    found = {n.rsplit(".", 1)[-1] for kind in (schemas.REPORT, schemas.CHUNK) for n, _ in report.places.leaves(kind)}
    assert set(K.CITATION_FIELDS) <= found


def test_beyond(spark, typed):
    sizes = spark.createDataFrame([("d", 50)], "call_id string, total_turns long")
    assert sorted(r["turn"] for r in quality.beyond(report.citations(typed), sizes).collect()) == [50, 60, 99]


def test_trims(typed):
    row = {r["call_id"]: r for r in report.trimmed(typed).collect()}
    trims = {t["path"]: (t["was"], t["cap"]) for t in row["d"]["trims"]}
    assert trims == {"lead_relevance.reason": (len(LONG) * 2, 800), "scorecard.purpose_of_call.justification": (801, 800), "sales_summary.snapshot_points[2]": (500, 400), "sales_summary.carry_forward.questions_asked[0]": (600, 400)}
    doc = row["d"]["report"]
    assert doc["lead_relevance"]["reason"].endswith("said.") and len(doc["lead_relevance"]["reason"]) <= 800
    assert doc["discovery_quality"]["questions_asked"] == ["q" * 900]  # no cap on this one
    assert doc["sales_summary"]["snapshot_points"] == ["plain", "paid at turn 9", "x" * 399 + "…"]
    assert doc["timeline"][1] is None and doc["customer_profile"] is None
    assert all(not r["trims"] for k, r in row.items() if k != "d")


def test_scrubs(typed):
    row = {r["call_id"]: r for r in report.scrubbed(typed).collect()}["d"]
    assert set(row["scrubs"]) == {"sales_summary.call_in_brief", "sales_summary.snapshot_points[1]", "sales_summary.improvements[0].title", "sales_summary.carry_forward.open_threads[0]"}
    assert row["report"]["sales_summary"]["call_in_brief"] == ", she said no, twice."
    assert row["report"]["sales_summary"]["snapshot_points"][:2] == ["plain", "Paid"]
    assert row["report"]["sales_summary"]["bottom_line"] == "no reference"
    assert row["report"]["call_purpose"]["text"] == "asked"


def _times(df, word):
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString().count(word)
    finally:
        df.sparkSession.conf.unset("spark.sql.debug.maxToStringFields")


def test_a_report_is_parsed_once(documents):
    """Not once for each of its fields, where an explode of the log sends a filter down."""
    rows = report.trimmed(report.read_reports(documents)).select("call_id", F.explode("trims").alias("l"))
    assert _times(rows, "from_json(") == 1
    assert {r["l"]["path"] for r in rows.collect()} >= {"lead_relevance.reason", "sales_summary.snapshot_points[2]"}

def test_a_text_is_scrubbed_once(typed):
    """The log goes by the new report and does not search the texts again."""
    texts = [n for n, k in report.places.leaves(report.schemas.REPORT) if n.startswith("sales_summary.") and k.typeName() == "string"]
    assert _times(report.scrubbed(typed).select("report", F.explode("scrubs").alias("path")), "turns?") == len(texts)


def test_unknown_keys(documents):
    rows = report.unknown_keys(documents).collect()
    assert {(r["call_id"], r["path"]) for r in rows} == {("d", p) for p in ("call_purpose.stray", "timeline[0].mood", "objections[0].quote.x", "scorecard.charm", "turn_index")} | {("o7", "objections.a")} - {("o7", "objections.a")}
    left = {r["call_id"]: r for r in report.without_unknown_keys(documents).collect()}
    clean = json.loads(json.dumps(DOC))
    for holder, key in ((clean["call_purpose"], "stray"), (clean["timeline"][0], "mood"), (clean["objections"][0]["quote"], "x"), (clean["scorecard"], "charm"), (clean, "turn_index")):
        del holder[key]
    assert json.loads(left["d"]["body"]) == clean
    assert [left[f"o{k}"]["body"] for k in range(len(ODD))] == ODD


def test_nodes_are_walked_in_one_pass(documents):
    from talkgrain.catalog.report import nodes

    found = nodes(documents.where("call_id = 'd'").select("call_id", F.try_parse_json("body").alias("v")), 9)
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()

    def plain(value, path=""):
        inner = [(f"{path}.{k}" if path else k, v) for k, v in value.items()] if isinstance(value, dict) else [(f"{path}[{i}]", v) for i, v in enumerate(value)] if isinstance(value, list) else []
        return [row for p, v in inner if v is not None for row in [(p, isinstance(v, dict)), *plain(v, p)]]

    assert sorted((r["path"], r["is_object"]) for r in found.collect()) == sorted(plain(DOC))


def test_violations(typed):
    rows = {(r["path"], r["rule"]) for r in report.violations(typed).where("call_id = 'd'").collect()}
    assert {r for r in rows if r[1] != "size"} == {
        ("timeline[2].phase", "enum"), ("compliance_flags[0].severity", "enum"), ("timeline[0].start_turn", "range"), ("scorecard.purpose_of_call.awarded", "range"), ("compliance_flags[0].occurrences", "range"),
        ("lead_relevance.reason", "length"), ("scorecard.purpose_of_call.justification", "length"), ("sales_summary.snapshot_points[2]", "item_length"), ("sales_summary.carry_forward.questions_asked[0]", "item_length")}
    assert {r[0] for r in rows if r[1] == "size"} == {"coaching.strengths", "coaching.coaching_actions", "sales_summary.improvements", "sales_summary.conversion_reasons"}


def test_a_list_of_many_flags_is_walked_in_one_row(spark):
    flags = [{"flag_type": "yelling", "quote": {"turn_index": k}} for k in range(20_000)]
    big = report.read_reports(spark.createDataFrame([("b", json.dumps({"compliance_flags": flags}))], "call_id string, body string"))
    assert report.citations(big).count() == 20_000
    assert report.violations(big).where("rule = 'enum'").count() == 20_000
