"""Ordered helpers and folds: the plain and the blocked way against simple loops."""

import random
import time

import pytest
from pyspark.sql import functions as F

from talkgrain.operators import conversation, flags
from talkgrain.plans import ordered, scan

WIDTHS = [None, 8]


def rows(seed, calls=4, most=60, spread=3):
    rng = random.Random(seed)
    out = []
    for call in range(calls):
        pos = 0
        for _ in range(rng.randint(0, most)):
            pos += rng.randint(1, spread)
            out.append((str(call), pos, rng.choice("AB"), rng.randint(0, 9)))
    rng.shuffle(out)
    return out


def by_call(data):
    grouped = {}
    for row in sorted(data, key=lambda r: (r[0], r[1])):
        grouped.setdefault(row[0], []).append(row)
    return grouped


@pytest.mark.parametrize("width", WIDTHS)
def test_windows(spark, width):
    data = rows(1)
    df = spark.createDataFrame(data, "call_id string, pos long, label string, v long").repartition(3)
    keys = ["call_id"]
    df = ordered.dense_index(df, keys, "pos", "idx", width)
    df = ordered.running_sum(df, keys, "pos", F.col("v"), "total", width)
    df = ordered.running_max(df, keys, "pos", F.col("v"), "top", width)
    df = ordered.previous(df, keys, "pos", ["label"], width)
    df = ordered.islands(df, keys, "pos", width, label="label")
    df = ordered.islands(df.withColumn("seven", F.col("v") == 7), keys, "pos", width, starts="seven", out="lucky")
    df = ordered.neighbours(df, keys, "idx", F.col("v"), 3, 2, width)
    got = {(r["call_id"], r["pos"]): r for r in df.collect()}
    want = 0
    for call, items in by_call(data).items():
        total, island, lucky = 0, 0, 0
        for i, (_, pos, label, v) in enumerate(items):
            r = got[(call, pos)]
            total += v
            island += i > 0 and items[i - 1][2] != label
            lucky += v == 7
            assert (r["idx"], r["total"], r["island"], r["lucky"]) == (i, total, island, lucky)
            assert r["top"] == (max(x[3] for x in items[:i]) if i else None)
            assert r["prev_label"] == (items[i - 1][2] if i else None)
            assert r["earlier"] == [x[3] for x in items[max(0, i - 3):i]]
            assert r["later"] == [x[3] for x in items[i + 1:i + 3]]
            want += 1
    assert want == len(got)


@pytest.mark.parametrize("width", WIDTHS)
def test_merged_turns(spark, width):
    data = rows(2)
    df = spark.createDataFrame(data, "call_id string, pos long, role string, v long").withColumn("text", F.col("v").cast("string"))
    got = sorted((r["call_id"], r["turn"], r["role"], r["text"]) for r in conversation.merged_turns(df, width=width).collect())
    want = []
    for call, items in by_call(data).items():
        merged = []
        for _, _, role, v in items:
            if merged and merged[-1][0] == role:
                merged[-1][1] += f" {v}"
            else:
                merged.append([role, str(v)])
        want += [(call, i, role, said) for i, (role, said) in enumerate(merged)]
        assert all(a[0] != b[0] for a, b in zip(merged, merged[1:]))
    assert got == sorted(want)


def loop_utterances(tokens, gap):
    found, now = [], None
    for _, _, said, speaker, start, end in tokens:
        if not said.strip():
            if now:
                now["text"] += said
            continue
        silent = now is not None and start is not None and now["end"] is not None and start - now["end"] > gap
        if now is None or now["speaker"] != speaker or silent:
            now = {"speaker": speaker, "start": start, "end": end, "text": said}
            found.append(now)
        else:
            now["text"] += said
            if end is not None:
                now["end"] = end
    return [(" ".join(u["text"].split()), u["speaker"], u["start"], u["end"]) for u in found]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed", [3, 4])
def test_utterances(spark, width, seed):
    rng = random.Random(seed)
    data = []
    for call in range(5):
        at = 0
        for pos in range(rng.randint(1, 60)):
            at += rng.randint(0, 40)
            blank = rng.random() < 0.2
            data.append((str(call), pos, " " if blank else rng.choice(["a", " b", "c "]), rng.choice("XXY"),
                         None if rng.random() < 0.2 else at, None if rng.random() < 0.4 else at + rng.randint(0, 10)))
    df = spark.createDataFrame(data, "call_id string, pos long, text string, speaker string, start_ms long, end_ms long").repartition(3)
    got = sorted((r["call_id"], r["utterance"], r["text"], r["speaker_id"], r["start_ms"], r["end_ms"])
                 for r in conversation.utterances(df, 20, width).collect())
    want = [(call, i, *u) for call, items in by_call(data).items() for i, u in enumerate(loop_utterances(items, 20))]
    assert [tuple(map(str, g)) for g in got] == [tuple(map(str, w)) for w in sorted(want, key=lambda w: (w[0], w[1]))]


RANK = {"low": 0, "medium": 1, "high": 2}


def loop_merge(items, gap=4):
    merged = []
    for f in sorted(items, key=lambda f: (f["turn"], f["seq"])):
        last = merged[-1] if merged else None
        if last and last["category"] == f["category"] and f["turn"] - last["turn"] <= gap:
            last["also"].append(f["turn"])
            if RANK[f["severity"]] > RANK[last["severity"]]:
                last["severity"] = f["severity"]
            if f["source"] != "conduct_scan":
                last["source"] = f["source"]
        else:
            merged.append({**f, "also": list(f["also_at_turns"])})
    anchors = {m["turn"] for m in merged}
    return [(m["turn"], m["seq"], m["category"], m["severity"], m["source"], sorted({t for t in m["also"] if t != m["turn"] and t not in anchors})) for m in merged]


@pytest.mark.parametrize("width, span", [(5, 70), (7, 70), (65_536, 70), (5, 1), (6, 300)])
def test_merge_neighbours(spark, width, span):
    rng = random.Random(6 + span)
    data = [{"call_id": str(c), "seq": i, "turn": rng.randint(0, span), "category": rng.choice("ppppq" if width == 7 else "pq"), "severity": rng.choice(list(RANK)),
             "source": rng.choice(["conduct_scan", "whole_call"]), "reason": "why", "also_at_turns": rng.sample(range(80), rng.randint(0, 2))}
            for c in range(4) for i in range(40)]
    df = spark.createDataFrame(data, "call_id string, seq long, turn long, category string, severity string, source string, reason string, also_at_turns array<long>")
    got = sorted((r["call_id"], r["turn"], r["seq"], r["category"], r["severity"], r["source"], r["also_at_turns"])
                 for r in flags.merge_neighbours(df.repartition(3), width=width).collect())
    want = sorted((str(c), *m) for c in range(4) for m in loop_merge([d for d in data if d["call_id"] == str(c)]))
    assert got == want


def test_groups_are_dealt_anew_after_a_join(spark):
    """Without a shuffle of its own, a scan of joined rows is torn apart when the join turns into a broadcast at run time."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (spark.range(40).selectExpr("id % 4 as k", f"id as {c}") for c in "xy")
        out = scan.streamed(a.join(b, ["k"]), ["k"], ["x"], ["x"], "n bigint", lambda _, rows: [(sum(1 for _ in rows),)])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan[plan.index("MapInArrow"):plan.index("SortMergeJoin")]
        assert sorted(tuple(r) for r in out.collect()) == [(k, 100) for k in range(4)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def loop_dedupe(items):
    kept = []
    for f in sorted(items, key=lambda f: f["seq"]):
        turns = set(f["occurrence_turns"]) | {f["turn_index"]}
        for k in kept:
            if k["flag_type"] == f["flag_type"] and k["turns"] & turns:
                if RANK[k["severity"]] < RANK[f["severity"]]:
                    k["severity"] = f["severity"]
                k["turns"] |= turns
                k["occurrences"] = max(k["occurrences"], f["occurrences"], len(k["turns"]))
                break
        else:
            kept.append({**f, "turns": turns})
    return [(k["flag_type"], k["seq"], k["severity"], k["occurrences"], sorted(k["turns"])) for k in kept]


@pytest.mark.parametrize("width", [3, 16, 65_536])
@pytest.mark.parametrize("seed", [7, 8])
def test_dedupe(spark, width, seed):
    rng = random.Random(seed)
    data = [{"call_id": str(c), "seq": i, "flag_type": rng.choice("xy"), "severity": rng.choice(list(RANK)), "turn_index": (t := rng.randint(0, 60)),
             "occurrences": rng.randint(1, 3), "occurrence_turns": [t + rng.randint(0, 3) for _ in range(rng.randint(0, 3))]}
            for c in range(4) for i in range(30)]
    df = spark.createDataFrame(data, "call_id string, seq long, flag_type string, severity string, turn_index long, occurrences long, occurrence_turns array<long>")
    got = sorted((r["call_id"], r["flag_type"], r["seq"], r["severity"], r["occurrences"], r["occurrence_turns"])
                 for r in flags.dedupe_flags(df.repartition(3), width).collect())
    assert got == sorted((str(c), *k) for c in range(4) for k in loop_dedupe([d for d in data if d["call_id"] == str(c)]))


@pytest.mark.parametrize("width", [3, 16, 65_536])
def test_carry_over_fates(spark, width):
    rng = random.Random(9)
    data = [(str(c), i, (t := rng.randint(0, 50)), sorted({t, *(t + rng.randint(-3, 3) for _ in range(rng.randint(0, 2)))}),
             rng.choice(["open", "open", "open", "dismissed", "not_conduct"])) for c in range(4) for i in range(40)]
    df = spark.createDataFrame(data, "call_id string, seq long, turn long, occurrence_turns array<long>, _state string")
    got = {(r["call_id"], r["seq"]): r["fate"] for r in flags._fates(df.repartition(3), width).collect()}
    want = {}
    for c in range(4):
        covered = set()
        for call, seq, turn, occ, state in data:
            if call == str(c):
                fate = "covered" if turn in covered else state if state != "open" else "carried"
                covered |= set(occ) if fate == "carried" else set()
                want[(call, seq)] = fate
    assert got == want


def test_scan_sums_across_blocks_and_keys(spark):
    """A running sum with the sum of a block as its summary, over NULLs in keys and values and a key without rows."""
    rng = random.Random(3)
    data = [(c, p, rng.choice([None, 1, 2, 3])) for c in ("a", "b", None) for p in rng.sample(range(-50, 400), 120)]
    df = spark.createDataFrame(data, "k string, pos long, v long").repartition(5)

    def running(state, rows):
        total = state[0] if state else 0
        for pos, v in rows:
            total += v or 0
            yield pos, total

    out = scan.scanned(df.where("k is not null"), ["k"], "pos", ["pos"], ["pos", "v"], summary="s bigint", state="s bigint", schema="pos bigint, total bigint", width=16,
                       summarise=lambda rows: (sum(v or 0 for _, v in rows),), enter=lambda state, s: ((state[0] if state else 0) + s[0],), apply=running)
    want = {}
    for k in "ab":
        total = 0
        for _, p, v in sorted((r for r in data if r[0] == k), key=lambda r: r[1]):
            total += v or 0
            want[k, p] = total
    assert {(r["k"], r["pos"]): r["total"] for r in out.collect()} == want
    streams = scan.streamed(df, ["k"], ["pos"], ["pos"], "n bigint, first bigint", lambda key, rows: [(len(own := [r[0] for r in rows]), own[0])])
    assert {r["k"]: (r["n"], r["first"]) for r in streams.collect()} == {c: (120, min(p for k, p, _ in data if k == c)) for c in ("a", "b", None)}
    assert scan.streamed(df.where("false"), ["k"], ["pos"], ["pos"], "n bigint", lambda key, rows: [(1,)]).collect() == []


def many_flags(spark, n):
    """n flags of one call: most at turns that chain up, a third of them on one turn."""
    turn = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % (n // 2))
    return spark.range(n).select(
        F.lit("hot").alias("call_id"), F.col("id").alias("seq"), turn.alias("turn"), F.when(F.col("id") % 1000 == 1, "q").otherwise("p").alias("category"), F.lit("low").alias("severity"),
        F.lit("whole_call").alias("source"), F.lit("why").alias("reason"), F.array().cast("array<bigint>").alias("also_at_turns"))


def test_many_flags_of_one_call(spark):
    """Work on a call's flags grows with their number: quadratic folds of so many would not end within the limit."""
    begin = time.time()
    n = 200_000
    rows = many_flags(spark, n)
    merged = flags.merge_neighbours(rows).agg(F.sum("flags_merged").alias("n"), F.count("*").alias("findings")).first()
    assert merged["n"] == n and merged["findings"] > n // 12
    report = rows.select("call_id", "seq", F.lit("x").alias("flag_type"), "severity", F.col("turn").alias("turn_index"), F.lit(1).cast("long").alias("occurrences"), F.array("turn", F.col("turn") + 1).alias("occurrence_turns"))
    deduped = flags.dedupe_flags(report).agg(F.sum("flags_merged").alias("n"), F.count("*").alias("left")).first()
    assert deduped["n"] == n and deduped["left"] < n // 2
    fates = flags._fates(rows.select("call_id", "seq", "turn", F.array("turn", F.col("turn") + 1).alias("occurrence_turns"), F.lit("open").alias("_state")), scan.WIDTH)
    assert {r["fate"] for r in fates.groupBy("fate").count().collect()} == {"carried", "covered"}
    assert time.time() - begin < 240


def test_plans_are_built_without_a_job(spark):
    rows = many_flags(spark, 100)
    spark.sparkContext.setJobGroup("plans", "none")
    try:
        flags.merge_neighbours(rows)
        flags.dedupe_flags(rows.select("call_id", "seq", F.lit("x").alias("flag_type"), "severity", F.col("turn").alias("turn_index"), F.lit(1).alias("occurrences"), "also_at_turns", F.array("turn").alias("occurrence_turns")))
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("plans") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_heavy_keys_take_the_blocked_way(spark):
    data = [("hot", i, "A") for i in range(50)] + [("cold", i, "A") for i in range(5)]
    df = spark.createDataFrame(data, "call_id string, pos long, label string")
    ways = []

    def build(rows, width):
        ways.append(width)
        return ordered.dense_index(rows, ["call_id"], "pos", "idx", width)

    out = ordered.by_size(df, ["call_id"], build, block=8, limit=10)
    assert ways == [None, 8]
    assert all(r["idx"] == r["pos"] for r in out.collect()) and out.count() == 55
