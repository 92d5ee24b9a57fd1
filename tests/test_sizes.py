"""What the plans of queries move, sort and hold, as far as it decides how they grow."""

from pyspark.sql import functions as F

from talkgrain import catalog
from talkgrain.catalog.report import first_documents, reports
from talkgrain.catalog.tables import Inputs
from talkgrain.operators import bookkeeping, conversation, costs, scorecard

FOLDER = "/root/testdata/sf0.001"


def explained(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_first_reports_are_chosen_before_they_are_parsed(spark, capsys):
    inputs = Inputs(spark, FOLDER)
    first = first_documents(inputs)
    above, below = explained(first, capsys).split("Exchange", 1)
    assert "from_json" in above and "from_json" not in below
    every = reports(inputs).groupBy(F.col("of_call").alias("call_id")).agg(F.min_by("report", "turn").alias("report"))
    told = lambda df: sorted(map(str, df.select("call_id", F.to_json("report")).collect()))
    assert told(first) == told(every)


def test_employees_are_picked_in_one_pass(spark, capsys):
    scores = spark.createDataFrame(
        [("a", "x", 3, 10, 0), ("a", "y", 1, 90, 1), ("b", "x", 2, 10, 0), ("b", "y", 2, 5, 1), ("b", "z", 0, 40, 2), ("c", "x", None, 7, 0), (None, "x", 1, 7, 0)],
        "call_id string, speaker_id string, marker_score long, chars long, first_pos long")
    picked = conversation.employee_speaker(scores)
    assert explained(picked, capsys).count("Scan ExistingRDD") == 1
    assert sorted(map(tuple, picked.collect())) == [("a", "x", "auto"), ("b", "z", "auto")]


def test_costs_of_calls_take_one_sort_of_the_calls(spark, capsys):
    for name in ("ag_23_call_costs", "ag_23_hourly_rate"):
        assert explained(catalog.QUERIES[name](spark, FOLDER), capsys).count("orders.parquet") == 1
    table = lambda rows, usd: spark.createDataFrame(rows, f"call_id string, {usd} double, duration_ms long")
    audio = table([("a", 0.5, 1000), ("a", None, 2000), ("b", None, 0), ("c", 0.25, None), ("d", 1.0, 5), (None, 1.0, 5), ("e", 2.0, 7), ("f", 2.0, 7)], "audio_cost_usd")
    analysis = table([("a", 1.0, 1), ("a", None, 1), ("b", 1.0, 1), ("c", None, 1), ("e", 4.0, 1), ("f", 1.0, 1), ("x", 1.0, 1), (None, 1.0, 1)], "cost_usd").drop("duration_ms")
    audit = table([("a", 2.0, 1), ("e", None, 1), ("x", 1.0, 1)], "cost_usd").drop("duration_ms")
    got = costs.audio_call_costs(audio, analysis, audit)
    want = costs.call_costs(costs.stage_totals(audio, audio, analysis, audit), audio)
    told = lambda df: sorted(map(str, df.select("call_id", "complete", "duration_ms", "total_usd", "audio_seconds", "usd_per_audio_hour").collect()))
    assert told(got) == told(want) and len(told(got)) == 7 and got.where("call_id = 'f'").first()["complete"]


def test_first_calls_are_in_no_join(spark, capsys):
    calls = spark.createDataFrame([("1",), ("2_follow_up",), ("2_follow_up",), ("3_follow_up",), (None,)], "call_id string")
    audits = spark.createDataFrame([("2", 5.0), ("2", 6.0), ("1", 7.0), (None, 8.0)], "call_id string, score double")
    got = bookkeeping.with_parent(calls, audits, ["score"])
    assert sorted(map(str, map(tuple, got.select("call_id", "is_follow_up_id", "parent_id", "parent_score", "parent_missing").collect()))) == sorted(map(str, [
        ("1", False, None, None, False), *[("2_follow_up", True, "2", x, False) for x in (5.0, 5.0, 6.0, 6.0)], ("3_follow_up", True, "3", None, True), (None, None, None, None, None)]))
    left = explained(got, capsys)
    assert "Union" in left and left.index("Union") < left.index("Join")


def test_a_card_is_shuffled_and_sorted_once(spark, capsys):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("scr_6_warnings", "scr_6_defaults_and_clamps", "scr_7_section_totals"):
            plan = explained(catalog.QUERIES[name](spark, FOLDER), capsys)
            assert plan.count("SortMergeJoin") == 4 and plan.count("Sort [") == 5, name  # the card and the four tables it meets
            assert not [x for x in plan.split("\n") if "Exchange hashpartitioning(call_id" in x and "criterion" in x], name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_repeats_and_flows_of_a_call_meet_their_lines(spark):
    card = spark.createDataFrame([("a", "purpose_of_call", True, 10), ("a", "pitch_flow_order", True, 10), ("a", "humour", False, 3), ("b", "purpose_of_call", False, 4), (None, "pitch_flow_order", True, 1)],
                                 "call_id string, criterion string, reached boolean, awarded long")
    flows = spark.createDataFrame([("a", "broken", "held", "held", ""), ("a", "held", "held", "held", ""), (None, "broken", "held", "held", "")],
                                  "call_id string, introduction_first string, qualification_block string, personalised_path_block string, justification string")
    repeats = spark.createDataFrame([("a", "purpose_of_call"), ("a", "purpose_of_call"), ("a", None), ("b", "purpose_of_call"), (None, "pitch_flow_order")], "call_id string, criterion string")
    follow = spark.createDataFrame([("a", True), ("b", True)], "call_id string, is_follow_up boolean")
    got = scorecard.apply_repetitions(scorecard.apply_flow(card, flows), repeats, follow)
    assert sorted(map(str, map(tuple, got.select("call_id", "criterion", "reached", "flow_changed", "repeats", "repeat_on_unreached").collect()))) == sorted(map(str, [
        ("a", "purpose_of_call", True, False, 2, False), ("a", "pitch_flow_order", True, True, 0, False), ("a", "pitch_flow_order", True, False, 0, False), ("a", "humour", False, False, 0, False),
        ("b", "purpose_of_call", False, False, 1, True), (None, "pitch_flow_order", True, False, 0, False)]))
