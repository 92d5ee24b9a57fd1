"""Hand-computed cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import marks, paths, text, timing
from talkgrain.operators import agents, calls, conversation, costs, flags, scorecard
from talkgrain.plans.lookup import first_containing
from talkgrain.plans.ranking import middle_values, rank_descending
from talkgrain.plans.similarity import overlapping_pairs
from talkgrain.sources import roster, storage, transcripts


def one(spark, build, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(build(F.col("v"))).collect()]


def test_phones(spark):
    assert one(spark, text.ten_digits, "+917307148543", "07050356192", "706", "N/A") == ["7307148543", "7050356192", "", ""]
    assert one(spark, text.did_key, "0706", "07971508911") == ["0706", "7971508911"]


def test_recording_url(spark):
    assert one(spark, calls.recording_url, "-", "N/A", "ftp://x", "https://x/a.wav") == ["", "", "", "https://x/a.wav"]


def test_times(spark):
    assert one(spark, timing.local_to_iso, "2026-09-20 02:00:00", "bad") == ["2026-09-19T20:30:00Z", ""]
    now = spark.createDataFrame([(dt.datetime(2026, 9, 20, 20, 28),), (dt.datetime(2026, 9, 20, 19, 30),)], "now timestamp")
    ends = [r[0] for r in now.select(timing.iso_utc(timing.last_complete_day("now")[1])).collect()]
    assert ends == ["2026-09-20T20:30:00Z", "2026-09-19T20:30:00Z"]
    with pytest.raises(ValueError):
        timing.explicit_window(None, "2026-09-20T00:00:00Z", dt.datetime(2026, 9, 21))
    utc = lambda *a: dt.datetime(*a, tzinfo=dt.timezone.utc)
    named = timing.explicit_window("2026-09-20T00:00:00", None, dt.datetime(2026, 9, 21))
    assert named == (utc(2026, 9, 20), utc(2026, 9, 21), "explicit") and not named.is_empty
    assert timing.explicit_window("2026-09-20T05:30:00+05:30", "2026-09-20T00:00:00Z", utc(2026, 9, 21)).is_empty
    assert timing.explicit_window(None, None, utc(2026, 9, 20, 20, 28))[:2] == (utc(2026, 9, 19, 20, 30), utc(2026, 9, 20, 20, 30))
    assert timing.explicit_window(None, None, dt.datetime(2026, 9, 20, 19, 30)).end == utc(2026, 9, 19, 20, 30)
    assert len(timing.run_id(spark)) == 25


def test_sanitize(spark):
    assert one(spark, text.sanitize, "abc नमस्ते Ա", "a​b ªc", "Ｘy") == ["abc नमस्ते", "ab c", "y"]
    assert one(spark, text.was_sanitized, "abc नमस्ते Ա", "a  b") == [True, False]


def test_slug(spark):
    assert one(spark, text.slug, "Pankaj  Kourav", "Ångström–Größe", "नमस्ते", "") == ["pankaj-kourav", "angstromgroe", "unknown", "unknown"]


def test_backchannel_and_fillers(spark):
    assert one(spark, text.is_backchannel, "Ok, haan।", "अपनी औकात में रहो", "", "yes yes yes yes") == [True, False, True, False]
    assert one(spark, text.is_filler, "हाँ।", "Ok.", "okay then") == [True, True, False]


def test_backchannel_is_one_pattern(spark):
    """The same lines as word by word, without lists in a row, and quick on long runs of blanks."""
    import re

    def plain(line):
        words = [w.strip(K.BACKCHANNEL_STRIP).lower() for w in re.split(r"\s+", line.replace("।", " "))]
        words = [w for w in words if w]
        return len(words) <= 3 and all(w in K.BACKCHANNEL_WORDS for w in words)

    draw = random.Random(5)
    parts = ["ok", "OK", "haan", "जी", "हम", "हम्म", "no", "okx", "so", "to", " ", " ", "  ", "\n", "\u00a0", "\x1c", "।", ".", ",", "-", "—", "'", "…", "/"]
    lines = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 7))) for _ in range(3000)] + ["ok" + " " * 50_000 + "no", " -" * 50_000 + "x", "ok,ok", "ok, ok", "ji\n", "ok no", "ok\u2028"]
    wanted = [plain(x) for x in lines]
    assert one(spark, text.is_backchannel, *lines) == wanted and 200 < sum(wanted) < 2800
    assert one(spark, lambda c: text.is_backchannel(c, ["jA", "-a", "b c", "x"]), "jA", "a", "b c", "x", "") == [False, False, False, True, True]
    plan = spark.range(1).select(text.is_backchannel(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "split(" not in plan


def test_prose(spark):
    assert one(spark, text.strip_turn_citations, "Fine (turns 3, 9 and 12), he agreed at turn 4.", "at turn 30 he left", "No change  here") == [
        "Fine, he agreed.", "He left", "No change  here"]
    assert one(spark, lambda v: text.shorten(v, 20), "Short.", "One two. Three four five", "abcdefghijklmnopqrstuvwxyz", "aaaa bbbb cccc dddd eeee") == [
        "Short.", "One two. Three four…", "abcdefghijklmnopqrs…", "aaaa bbbb cccc dddd…"]
    assert one(spark, text.redact_phones, "call 98765 43210 now", "order 1234") == ["call [REDACTED_PHONE] now", "order 1234"]
    assert one(spark, text.strip_fences, "```json\n{}\n```", " {} ") == ["{}", "{}"]


def test_marks(spark):
    df = spark.createDataFrame([("qualification_questions", 8, 1), ("qualification_questions", 10, 9)], "c string, m long, s long")
    assert [r[0] for r in df.select(marks.step_down("c", "m", "s")).collect()] == [3, 0]
    assert scorecard.scheme_faults(scorecard.criteria(spark)).count() == 0
    flows = spark.createDataFrame([("1", "held", "broken", "not_reached", ""), ("2", "not_reached", "not_reached", "not_reached", "x")],
                                  "call_id string, introduction_first string, qualification_block string, personalised_path_block string, justification string")
    got = [(r["flow_awarded"], r["flow_reached"]) for r in scorecard.flow_marks(flows).orderBy("call_id").collect()]
    assert got == [(7, True), (10, False)]


def test_scores_and_void(spark):
    full = [("1", c, m, 35 if False else m) for c, m in K.CRITERION_MAX.items()]
    card = spark.createDataFrame([("1", c, m, True) for _, c, m, _ in full] + [("2", c, m // 2 if m == 10 else 0, True) for _, c, m, _ in full],
                                 "call_id string, criterion string, awarded long, reached boolean")
    marked = (card.withColumns({"deduction": F.lit(0), "not_applicable": F.lit(False), "is_follow_up": F.lit(False), "is_relevant": F.lit(True)}))
    totals = flags.flag_totals(spark.createDataFrame([("2", "abusive_language")], "call_id string, flag_type string"))
    got = {r["call_id"]: (r["earned_marks"], r["score_before_flags"], r["overall_score_100"]) for r in scorecard.scores(marked, totals).collect()}
    assert got == {"1": (70, 100.0, 100.0), "2": (25, 35.7, 0.0)}


@pytest.mark.parametrize("n,starts", [(60, [0]), (61, [0, 54]), (114, [0, 54]), (115, [0, 54, 108])])
def test_chunks(spark, n, starts):
    turns = spark.range(n).select(F.lit("c").alias("call_id"), F.col("id").alias("turn"))
    placed = conversation.chunks(turns)
    assert sorted({r[0] for r in placed.select("chunk_start").collect()}) == starts
    assert placed.select("turn").distinct().count() == n
    assert spark.range(1).select(conversation.chunk_starts(F.lit(n))).first()[0] == starts


def test_merge_is_measured_from_the_anchor(spark):
    df = spark.createDataFrame([("c", i, t, "rude", "low", "conduct_scan", "why", []) for i, t in enumerate((24, 26, 30, 34))],
                               "call_id string, seq long, turn long, category string, severity string, source string, reason string, also_at_turns array<long>")
    got = {r["turn"]: (r["also_at_turns"], r["reason"]) for r in flags.merge_neighbours(df).collect()}
    assert got == {24: ([26], "why Continues across turns 26."), 30: ([34], "why Continues across turns 34.")}


def test_dedupe_is_not_transitive(spark):
    df = spark.createDataFrame([("c", 0, "x", "low", 1, 1, [2]), ("c", 1, "x", "low", 4, 1, [5]), ("c", 2, "x", "high", 2, 1, [4])],
                               "call_id string, seq long, flag_type string, severity string, turn_index long, occurrences long, occurrence_turns array<long>")
    got = sorted((r["seq"], r["occurrence_turns"], r["severity"]) for r in flags.dedupe_flags(df).collect())
    assert got == [(0, [1, 2, 4], "high"), (1, [4, 5], "low")]


def test_median_is_floored(spark):
    segs = [("c", "Customer", 0, 1, 0), ("c", "Customer", 4, 5, 1), ("c", "Customer", 11, 12, 2)]
    df = spark.createDataFrame(segs, "call_id string, speaker string, start_ms long, end_ms long, pos long")
    assert conversation.talk_pattern(df).first()["median_gap_ms"] == 5


def test_employee_pick_on_a_tie(spark):
    df = spark.createDataFrame([("c", "A", 2, 10, 0), ("c", "B", 2, 20, 1), ("c", "C", 0, 90, 2), ("d", "A", 3, 1, 0), ("d", "B", 2, 99, 1)],
                               "call_id string, speaker_id string, marker_score long, chars long, first_pos long")
    assert {r["call_id"]: r["employee_speaker"] for r in conversation.employee_speaker(df).collect()} == {"c": "C", "d": "A"}


def test_locate(spark):
    turns = spark.createDataFrame([("c", i, "Employee", s) for i, s in enumerate(
        ["you will regret this", "b", "c", "never call  me again please", "e", "f", "g", "h", "i", "you will regret this"])],
        "call_id string, turn long, speaker string, text string")
    asked = spark.createDataFrame([("c", 0, "call me again", 4, "employee"), ("c", 1, "will regret", None, ""), ("c", 2, "egret", 9, ""),
                                   ("c", 3, "call me again", 4, "Customer"), ("c", 4, "  ", 1, "")],
                                  "call_id string, seq long, phrase string, stated long, speaker string")
    got = {r["seq"]: r["found_turn"] for r in flags.locate_phrases(asked, turns).collect()}
    assert got == {0: 3, 1: 0, 2: 9, 3: None, 4: None}


def test_first_containing_by_brute_force(spark):
    rng = random.Random(1)
    words = ["ab", "abc", "b", "cab", "bca", "a", "cc"]
    texts = [("g", " ".join(rng.choices(words, k=rng.randint(1, 6))), i) for i in range(60)]
    asked = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4)))[rng.randint(0, 1):].strip() or "a" for _ in range(60)})
    got = {r["p"]: r["at"] for r in first_containing(
        spark.createDataFrame([("g", p) for p in asked], "k string, p string"),
        spark.createDataFrame(texts, "k string, t string, i long"), ["k"], "p", "t", "i", "at").collect()}
    want = {p: min(i for _, t, i in texts if p in t) for p in asked if any(p in t for _, t, _ in texts)}
    assert got == want


@pytest.mark.parametrize("share", [0.5, 0.1])
def test_overlapping_pairs_by_brute_force(spark, share):
    rng = random.Random(2)
    side = lambda: [("g", i, rng.sample("abcdefghijkl", rng.randint(0, 6))) for i in range(40)]
    a, b = side(), side()
    got = {(r["l"], r["r"]) for r in overlapping_pairs(
        spark.createDataFrame(a, "k string, l long, tokens array<string>"), spark.createDataFrame(b, "k string, r long, tokens array<string>"), "k", "l", "r", share=share).collect()}
    want = {(i, j) for _, i, x in a for _, j, y in b if x and y and len(set(x) & set(y)) / min(len(x), len(y)) >= share}
    assert got == want


def test_many_phrases_in_one_group(spark):
    """More phrases than are tried one by one, of words and of parts of words, give the same places."""
    from talkgrain.plans import lookup

    rng = random.Random(3)
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 5))) for _ in range(60)]
    texts = [("g", " ".join(rng.choices(words, k=8)), i) for i in range(80)]
    asked = sorted({" ".join(rng.choice(texts)[1].split(" ")[rng.randint(0, 4):][:rng.randint(1, 4)])[rng.randint(0, 1):].strip() or "a" for _ in range(400)})
    assert len({(p.split(" ")[1:-1] or [max(p.split(" "), key=len)[:3]])[0] for p in asked}) > lookup.FEW
    got = {r["p"]: r["at"] for r in first_containing(
        spark.createDataFrame([("g", p) for p in asked], "k string, p string"), spark.createDataFrame(texts, "k string, t string, i long"), ["k"], "p", "t", "i", "at").collect()}
    assert got == {p: min(i for _, t, i in texts if p in t) for p in asked if any(p in t for _, t, _ in texts)}


def test_lookup_moves_asked_anchors_only(spark):
    """What goes from texts to phrases does not grow with the words of a text."""
    texts = spark.createDataFrame([("g", f"{' '.join(f'w{k}x{i}' for k in range(300))} the very end", i) for i in range(5)], "k string, t string, i long")
    asked = spark.createDataFrame([("g", "the very end"), ("g", "w7x4")], "k string, p string")
    found = first_containing(asked, texts, ["k"], "p", "t", "i", "at")
    assert {r["p"]: r["at"] for r in found.collect()} == {"the very end": 0, "w7x4": 4}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" in plan and plan.index("Generate explode(_found") >= 0


@pytest.mark.parametrize("few", [0, 1_000, 1_000_000])
def test_overlapping_pairs_of_small_and_large_groups(spark, few):
    rng = random.Random(4)
    side = lambda: [(g, i, rng.sample("abcdefghijklmnop", rng.randint(0, 7))) for g, n in (("s", 9), ("t", 50)) for i in range(n)]
    a, b = side(), side()
    got = sorted((r["k"], r["l"], r["r"]) for r in overlapping_pairs(
        spark.createDataFrame(a, "k string, l long, tokens array<string>"), spark.createDataFrame(b, "k string, r long, tokens array<string>"), "k", "l", "r", few=few).collect())
    assert got == sorted((g, i, j) for g, i, x in a for h, j, y in b if g == h and x and y and len(set(x) & set(y)) / min(len(x), len(y)) >= 0.5)


def test_order_statistics(spark):
    rng = random.Random(3)
    data = [(str(k), rng.randint(0, 5000)) for k in range(3) for _ in range(10 + k)]
    df = spark.createDataFrame(data, "k string, v long")
    got = {r["k"]: (r["low_mid"], r["high_mid"]) for r in middle_values(df, ["k"], "v").collect()}
    for k in got:
        values = sorted(v for c, v in data if c == k)
        assert got[k] == (values[(len(values) - 1) // 2], values[len(values) // 2])
    ranked = rank_descending(df, "v", F.floor(F.col("v") / 100)).collect()
    assert all(r["rank"] == 1 + sum(v > r["v"] for _, v in data) for r in ranked)


def test_rates(spark):
    df = spark.createDataFrame([("gpt-5.4-mini-2026-04-01",), ("gpt-5.4-x",), ("other",)], "model string")
    assert [r["card"] for r in costs.with_rates(df).collect()] == ["gpt-5.4-mini", "gpt-5.4", None]
    used = spark.createDataFrame([("gpt-5.6-luna", 1_000_000, 600_000, 0, 0, 100_000)],
                                 "model string, prompt_tokens long, cached_tokens long, completion_tokens long, reasoning_tokens long, cache_write_tokens long")
    assert costs.priced(used, ["model"]).first()["cost_usd"] == 0.097


def test_shared_direct_number_is_no_fallback(spark):
    df = spark.createDataFrame([(i, str(i), "n", d, "", "", "") for i, d in enumerate(["1", "1", "2", "2", "2", "3"])],
                               "pos long, extension string, name string, did string, account_id string, tl string, state string")
    assert [r["did_key"] for r in agents.did_index(df).collect()] == ["3"]


def test_display_alignment(spark):
    clean = spark.createDataFrame([(c, i, "t") for c in "ab" for i in range(3)], "call_id string, turn long, text string")
    timed = spark.createDataFrame([("a", i, i * 10, i * 10 + 5) for i in range(3)] + [("b", i, i, i) for i in range(2)],
                                  "call_id string, turn long, start_ms long, end_ms long")
    got = {(r["call_id"], r["turn"]): r["start_ms"] for r in conversation.aligned_display(clean, timed).collect()}
    assert got == {("a", 0): 0, ("a", 1): 10, ("a", 2): 20, ("b", 0): None, ("b", 1): None, ("b", 2): None}


def test_paths(spark):
    assert one(spark, paths.call_id_of_file, "/x/audio_4.clean.json", "audio_4.json", "a.b.wav") == ["audio_4", "audio_4", "a.b"]
    assert one(spark, paths.parent_call_id, "audio_92_follow_up", "audio_92", "_follow_up") == ["audio_92", None, None]


def test_documents(spark):
    docs = spark.createDataFrame([("1", '{"transcript":[{"speaker":"Employee","text":" hi "},7,{"speaker":"x","statement":"yo"},{"speaker":"x","text":" "}]}'),
                                  ("2", '[{"Employee":"a"},{"Customer":"b"}]')], "call_id string, body string")
    got = sorted((r["call_id"], r["turn"], r["speaker"], r["text"]) for r in transcripts.read_turns(docs).collect())
    assert got == [("1", 0, "Employee", "hi"), ("1", 1, "Customer", "yo"), ("2", 0, "Employee", "a"), ("2", 1, "Customer", "b")]


def test_roster_file(spark, tmp_path):
    path = tmp_path / "agents.json"
    path.write_text('{"_comment": "x", "agents": [{"extension": " 7 ", "name": "Old"}, {"extension": "7", "name": "New", "tl": "T"}, {"name": "none"}]}')
    entries = roster.read_roster_entries(spark, str(path))
    found = roster.resolve_roster(entries)
    assert [(r["extension"], r["name"], r["audited"]) for r in found.collect()] == [("7", "New", True)]
    roster.write_roster(found, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first()["team_leader_name"] == "T"


def test_sinks(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "pk string, date_key string, n long")
    path = str(tmp_path / "rollups")
    storage.overwrite_days(rows(("A", "2026-01-01", 1), ("B", "2026-01-01", 1), ("A", "2026-01-02", 1)), path)
    for _ in range(2):
        storage.overwrite_days(rows(("A", "2026-01-01", 5)), path)
        got = sorted((r["pk"], str(r["date_key"]), r["n"]) for r in spark.read.parquet(path).collect())
        assert got == [("A", "2026-01-01", 5), ("A", "2026-01-02", 1)]
    storage.overwrite_days(rows(("A", "2026-01-01", 7)), path, touched=spark.createDataFrame([("2026-01-01",), ("2026-01-02",)], "date_key string"))
    assert [(r["pk"], str(r["date_key"]), r["n"]) for r in spark.read.parquet(path).collect()] == [("A", "2026-01-01", 7)]
    ids = lambda *r: spark.createDataFrame([(x,) for x in r], "call_id string")
    store = str(tmp_path / "calls")
    ids("1", "2").write.parquet(store)
    storage.insert_if_absent(ids("2", "3", "3"), spark.read.parquet(store), store)
    assert sorted(r[0] for r in spark.read.parquet(store).collect()) == ["1", "2", "3"]
    docs = spark.createDataFrame([("1", "audit", dt.datetime(2026, 9, 16, 5), "{}")], "call_id string, kind string, started_at timestamp, body string")
    storage.write_artifacts(docs, str(tmp_path / "files"))
    assert (tmp_path / "files" / "kind=audit" / "yyyy=2026" / "mm=09" / "dd=16").is_dir()
    for _ in range(2):
        storage.write_artifacts(docs, str(tmp_path / "runs"), run="r1")
    assert spark.read.json(str(tmp_path / "runs")).count() == 1
    long_call = spark.range(25).select(F.lit("c").alias("call_id"), F.col("id").alias("turn"), F.lit("E").alias("speaker"), F.lit("t").alias("text"),
                                       F.lit(0).alias("start_ms"), F.lit(1).alias("end_ms"))
    whole = storage.attach_transcript(ids("c", "d"), long_call)
    assert sorted((r["call_id"], len(r["transcript"] or [])) for r in whole.collect()) == [("c", 25), ("d", 0)]
    marks = storage.split_by_presence(ids("1", "9", "9"), spark.read.parquet(store))
    assert sorted((r["call_id"], r["accepted"]) for r in marks.collect()) == [("1", False), ("9", False), ("9", True)]


def test_rollup_sums(spark):
    from talkgrain import catalog

    rows = catalog.QUERIES["ag_1_day_rollup"](spark, "/root/testdata/sf0.001")
    sums = {r["scope"]: tuple(r)[1:] for r in rows.groupBy("scope").agg(F.sum("total_calls"), F.sum("total_flags"), F.round(F.sum("score_sum"), 2)).collect()}
    assert len(set(sums.values())) == 1 and len(sums) == 3


def test_two_claims_of_one_call(spark):
    stored = spark.createDataFrame([("1", "UNPROCESSED"), ("2", "UNPROCESSED"), ("3", "FAILED")], "call_id string, processing_status string")
    changes = spark.createDataFrame(
        [("1", "UNPROCESSED", "AUDITING", 2), ("1", "UNPROCESSED", "AUDITING", 1), ("1", "AUDITING", "PROCESSED", 3), ("2", None, "FAILED", 1), ("3", "UNPROCESSED", "AUDITING", 1), ("9", None, "FAILED", 1)],
        "call_id string, expected_status string, new_status string, n int")
    got = {(r["call_id"], r["n"]): (r["applied"], r["status_after"]) for r in calls.apply_status_changes(stored, changes, ("n",)).collect()}
    assert got == {("1", 1): (True, "AUDITING"), ("1", 2): (False, "AUDITING"), ("1", 3): (True, "PROCESSED"), ("2", 1): (True, "FAILED"), ("3", 1): (False, "FAILED"), ("9", 1): (False, None)}


def test_costs_of_short_and_mixed_calls(spark):
    from talkgrain.operators import costs

    stages = spark.createDataFrame([("a", "transcribe", 0.0000282)], "call_id string, stage string, stage_usd double")
    second = spark.createDataFrame([("a", 1000)], "call_id string, duration_ms long")
    row = costs.call_costs(stages, second).first()
    assert (row["total_usd"], row["usd_per_audio_hour"], row["complete"]) == (0.000028, 0.1015, False)
    one = lambda *r: spark.createDataFrame(list(r), "call_id string, cost_usd double")
    known = spark.createDataFrame([("a",)], "call_id string")
    mixed = costs.stage_totals(known, one(("a", 0.1)), one(("a", 0.2), ("a", 0.3)), one(("b", 1.0)))
    assert sorted((r["stage"], round(r["stage_usd"], 6)) for r in mixed.collect()) == [("analyse", 0.5), ("transcribe", 0.1)]
    assert costs.call_costs(mixed, second).first()["complete"]


def test_empty_usage_is_no_call(spark):
    from talkgrain import schemas
    from talkgrain.operators import costs

    blocks = spark.createDataFrame([("{}",), ('{"prompt_tokens": 0}',), (None,)], "j string").select(F.from_json("j", schemas.USAGE).alias("usage"))
    assert costs.ledger(costs.flatten_usage(blocks), []).first()["calls"] == 1


def test_repeat_on_an_unreached_line_of_an_irrelevant_lead(spark):
    from talkgrain.operators import scorecard

    card = spark.createDataFrame([("c", "why_what_how_explanation", False, 3), ("c", "purpose_of_call", False, 3)], "call_id string, criterion string, reached boolean, awarded long")
    repeats = spark.createDataFrame([("c", "why_what_how_explanation")], "call_id string, criterion string")
    follow = spark.createDataFrame([("c", True)], "call_id string, is_follow_up boolean")
    lead = spark.createDataFrame([("c", False)], "call_id string, is_relevant boolean")
    card = card.withColumn("flow_changed", F.lit(False))
    marked = scorecard.apply_defaults(scorecard.apply_relevance(scorecard.apply_repetitions(card, repeats, follow), lead))
    warned = {(r["criterion"], r["warning"]) for r in scorecard.score_warnings(marked).collect()}
    assert ("why_what_how_explanation", "repeat_on_unreached") in warned and ("purpose_of_call", "repeat_on_unreached") not in warned


def test_reasons_a_row_keeps(spark):
    stored = spark.createDataFrame([("1", "PROCESSED", None, "old"), ("2", "UNPROCESSED", None, None)], "call_id string, processing_status string, started_at timestamp, failure_reason string")
    jobs = spark.createDataFrame([("1", True, None, None), ("2", True, None, None)], "call_id string, audio_present boolean, error_kind string, error string")
    got = {r["call_id"]: (r["outcome"], r["detail"], r["failure_reason"]) for r in calls.audit_disposition(jobs, stored).collect()}
    assert got == {"1": ("skipped", "already PROCESSED", "old"), "2": ("failed", "no audioKey", "queued for audit but the row has no audioKey")}


def test_prefix_in_whole_numbers(spark):
    from talkgrain.plans import similarity

    left = spark.createDataFrame([("g", 1, [f"a{k}" for k in range(55)] + [f"l{k}" for k in range(45)])], "g string, i int, tokens array<string>")
    right = spark.createDataFrame([("g", 2, [f"a{k}" for k in range(55)] + [f"r{k}" for k in range(45)])], "g string, j int, tokens array<string>")
    assert similarity.overlapping_pairs(left, right, "g", "i", "j", share=0.55).count() == 1


def test_collection_views_hold_both_kinds(spark):
    from talkgrain import catalog

    folder = "/root/testdata/sf0.001"
    assert catalog.QUERIES["jn_1_unknown_ids"](spark, folder).count() > 0
    assert catalog.QUERIES["prj_20_disposition"](spark, folder).select("pile").distinct().count() >= 3
    assert catalog.QUERIES["snk_3_insert_if_absent"](spark, folder).select("accepted").distinct().count() == 2
