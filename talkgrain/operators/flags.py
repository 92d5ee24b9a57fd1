"""Conduct flags: verdicts, anchoring to the transcript, merging, carry-over, de-duplication.

Turns here are dense indices from 0 (``turn``) except where a flag states its own number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import marks, text
from talkgrain.plans import ordered, scan
from talkgrain.plans.lookup import first_containing
from talkgrain.plans.similarity import overlapping_pairs


def flags_from_verdicts(verdicts: DataFrame, turns: DataFrame) -> DataFrame:
    """Flagged verdicts as flags, defaults filled in; the turn number counts from 1."""
    flagged = verdicts.where(F.coalesce("flagged", F.lit(False)))
    spoken = turns.select("call_id", "turn", "speaker", F.col("text").alias("_text"))
    own = lambda c, other: F.coalesce(text.blank_to_null(c), other)
    return flagged.join(spoken, ["call_id", "turn"]).select(
        "call_id", (F.col("turn") + 1).alias("turn"), "speaker",
        text.strip(own("phrase", F.col("_text"))).alias("phrase"),
        own("category", F.lit("other")).alias("category"), own("severity", F.lit("medium")).alias("severity"),
        F.coalesce("reason", F.lit("")).alias("reason"), F.lit("conduct_scan").alias("source"))


def flag_type(category: Column | str) -> Column:
    """Conduct type of a category: known ones first, then the first keyword inside it."""
    value = F.col(category) if isinstance(category, str) else category
    table = F.create_map(*[F.lit(x) for pair in K.FLAG_TYPE_BY_CATEGORY.items() for x in pair])
    by_word = F.when(F.lit(False), "")
    for word, kind in K.FLAG_TYPE_BY_KEYWORD:
        by_word = by_word.when(F.contains(value, F.lit(word)), kind)
    return F.coalesce(F.try_element_at(table, value), by_word.otherwise(K.DEFAULT_FLAG_TYPE))


def is_conduct(category: Column | str) -> Column:
    value = F.col(category) if isinstance(category, str) else category
    return ~value.isin(list(K.NON_CONDUCT_CATEGORIES))


def locate_phrases(flags: DataFrame, turns: DataFrame, phrase: str = "phrase", stated: str = "stated",
                   speaker: str | None = "speaker", out: str = "found_turn") -> DataFrame:
    """The turn a phrase is in: the stated one, the one before, the one after, else the first.

    With ``speaker`` the turn must be that speaker's, case aside; a flag without a speaker may be in
    any turn.  NULL when the phrase is nowhere in the call.
    """
    said = F.lower(speaker) if speaker else F.lit("")
    wanted = flags.withColumns({"_needle": text.collapse_space(F.coalesce(F.col(phrase), F.lit(""))),
                                "_said": F.coalesce(text.blank_to_null(said), F.lit("*")),
                                "_stated": F.coalesce(F.col(stated), F.lit(_NOWHERE)).cast("bigint")})
    voiced = turns.select("call_id", F.col("turn").cast("bigint").alias("_turn"), text_normal("text").alias("_hay"), F.lower("speaker").alias("_voice"))
    heard = voiced.select("call_id", "_turn", "_hay", F.explode(F.array("_voice", F.lit("*"))).alias("_said"))
    ask = ["call_id", "_said", "_needle", "_stated"]
    offsets = F.array(*[F.struct(F.lit(rank).alias("r"), F.lit(step).alias("d")) for rank, step in enumerate((0, -1, 1))])
    near = (wanted.where((F.col("_needle") != "") & (F.col("_stated") != _NOWHERE)).select(*ask).distinct()
            .withColumn("_try", F.explode(offsets)).withColumn("_turn", F.col("_stated") + F.col("_try.d"))
            .join(voiced, ["call_id", "_turn"]).where(F.col("_said").isin("*", F.col("_voice")) & F.contains("_hay", F.col("_needle")))
            .groupBy(*ask).agg(F.min_by("_turn", "_try.r").alias("_near")))
    marked = wanted.join(near, ask, "left")
    far = first_containing(marked.where(F.col("_near").isNull()), heard, ["call_id", "_said"], "_needle", "_hay", "_turn", "_far")
    return (marked.join(far, ["call_id", "_said", "_needle"], "left")
            .withColumn(out, F.coalesce("_near", "_far")).drop("_needle", "_said", "_stated", "_near", "_far"))


_NOWHERE = -1_000_000_000


def text_normal(value: Column | str) -> Column:
    """White space as single spaces, ends kept as one space too."""
    column = F.col(value) if isinstance(value, str) else value
    return F.regexp_replace(column, r"(?U)[\s\x1c-\x1f]+", " ")


def reanchor(flags: DataFrame, turns: DataFrame) -> DataFrame:
    """Move a report flag to the employee turn its quoted words are in.

    Columns ``verbatim``, ``turn_index``, ``occurrence_turns``.  A flag whose words are not found
    stays; in a moved one the new turn takes the old one's place among the occurrences.
    """
    asked = flags.withColumn("_who", F.lit("Employee"))
    found = locate_phrases(asked, turns, "verbatim", "turn_index", "_who", "_found").drop("_who")
    moved = F.col("_found").isNotNull() & (F.col("_found") != F.col("turn_index"))
    rest = F.filter("occurrence_turns", lambda t: t != F.col("turn_index"))
    swapped = F.array_sort(F.array_distinct(F.concat(F.array("_found"), rest)))
    return (found.withColumn("moved", moved)
            .withColumn("occurrence_turns", F.when(F.col("moved"), swapped).otherwise(F.col("occurrence_turns")))
            .withColumn("turn_index", F.when(F.col("moved"), F.col("_found")).otherwise(F.col("turn_index")))
            .drop("_found"))


def merge_neighbours(flags: DataFrame, gap: int = K.MERGE_GAP_TURNS, width: int = scan.WIDTH) -> DataFrame:
    """Flags of one category within ``gap`` turns of the first become one finding.

    Rows carry ``turn``, ``seq`` (order of arrival), ``category``, ``severity``, ``source``,
    ``reason`` and ``also_at_turns``.  In turn order, a flag joins the finding before it if the
    category is the same and its turn is at most ``gap`` past that finding's first turn.

    One ordered scan finds the finding of each flag, by its first flag's turn and order of arrival.
    """
    if width <= gap:
        raise ValueError("a block must be wider than the gap")
    rows = flags.withColumn("_c", F.coalesce("category", F.lit("")))
    finding = _findings(rows, gap, width)
    own = ["call_id", "turn", "seq"]
    tagged = rows.drop("_c").join(finding, own)
    place = F.struct("turn", "seq")
    is_first = (F.col("turn") == F.col("_anchor")) & (F.col("seq") == F.col("_first"))
    base = F.struct("category", "severity", "source", "reason", "seq", *[c for c in ("speaker", "phrase") if c in flags.columns])
    rank = F.coalesce(marks.severity_rank("severity"), F.lit(1))
    whole = F.when(F.coalesce("source", F.lit("")) != "conduct_scan", F.struct(place.alias("p"), F.coalesce("source", F.lit("whole_call")).alias("source")))
    merged = tagged.groupBy("call_id", "_anchor", "_first").agg(
        F.min_by(base, place).alias("b"), F.count("*").alias("flags_merged"),
        F.min_by(F.struct("severity"), F.struct((-rank).alias("r"), place.alias("p"))).alias("_worst"),
        F.max(F.when(~is_first, whole)).alias("_whole"))
    spread = _spread(tagged, is_first)
    return (merged.join(spread, ["call_id", "_anchor", "_first"], "left").select(
        "call_id", F.col("_anchor").alias("turn"), *[F.col(f"b.{c}").alias(c) for c in ("seq", "category")],
        *[F.col(f"b.{c}").alias(c) for c in ("speaker", "phrase") if c in flags.columns],
        F.col("_worst.severity").alias("severity"),
        F.coalesce("_whole.source", "b.source").alias("source"),
        F.when(F.size("also") > 0, F.concat(
            F.regexp_replace(F.coalesce("b.reason", F.lit("")), r"(?U)\s+$", ""), F.lit(" Continues across turns "),
            F.array_join(F.transform("also", lambda t: t.cast("string")), ", "), F.lit("."))).otherwise(F.col("b.reason")).alias("reason"),
        F.coalesce("also", F.array().cast("array<bigint>")).alias("also_at_turns"), "flags_merged"))


def _findings(rows: DataFrame, gap: int, width: int) -> DataFrame:
    """(call_id, turn, seq, _anchor, _first) of each flag.

    The state is the last finding: its category, and turn and seq of its first flag.  A block can be entered with a finding that
    began 1 to ``gap`` turns before it, or with none that matters; its summary says what each of these makes of it, and the
    category that such a finding must have to matter.
    """
    def walk(state, flags):
        for turn, seq, category in flags:
            if state is None or state[0] != category or turn - state[1] > gap:
                state = (category, turn, seq)
            yield turn, seq, state

    def summarise(flags):
        first, ends, taken = None, None, [True] * gap
        for turn, seq, category in flags:
            if first is None:
                first = category
                start = turn // width * width
                ends = [(first, start - d, None) for d in range(1, gap + 1)] + [None]
            for k, end in enumerate(ends):
                if end is None or end[0] != category or turn - end[1] > gap:
                    ends[k] = (category, turn, seq)
                    if k < gap:
                        taken[k] = False
        # For each finding before the block: whether it goes on to the block's end, and else what the block ends with.
        return first, start, [dict(open=k < gap and taken[k], category=e[0], turn=e[1], seq=e[2]) for k, e in enumerate(ends)]

    def enter(state, summary):
        first, start, ends = summary
        back = start - state[1] if state is not None and state[0] == first else 0
        end = ends[back - 1] if 0 < back <= gap else ends[gap]
        return state if end["open"] else (end["category"], end["turn"], end["seq"])

    def apply(state, flags):
        for turn, seq, (_, anchor, first) in walk(state, flags):
            yield turn, seq, anchor, first

    return scan.scanned(
        rows, ["call_id"], "turn", ["turn", "seq"], ["turn", "seq", "_c"], width=width, summarise=summarise, enter=enter, apply=apply,
        summary="first string, start bigint, ends array<struct<open boolean, category string, turn bigint, seq bigint>>",
        state="category string, turn bigint, seq bigint", schema="turn bigint, seq bigint, _anchor bigint, _first bigint")


def _spread(tagged: DataFrame, is_first: Column) -> DataFrame:
    """The other turns of each finding: those folded in and those its first flag listed.

    A turn that anchors a finding of its own is in no other finding's spread.
    """
    finding = ["call_id", "_anchor", "_first"]
    named = tagged.select(*finding, F.explode(F.concat(
        F.when(is_first, F.coalesce("also_at_turns", F.array().cast("array<bigint>"))).otherwise(F.array("turn")),
        F.array().cast("array<bigint>"))).alias("_t")).where(F.col("_t").isNotNull() & (F.col("_t") != F.col("_anchor")))
    anchors = tagged.select("call_id", F.col("_anchor").alias("_t")).distinct()
    kept = named.distinct().join(anchors, ["call_id", "_t"], "left_anti")
    return kept.groupBy(*finding).agg(F.array_sort(F.collect_list("_t")).alias("also"))


def add_scan_flags(existing: DataFrame, scan: DataFrame) -> DataFrame:
    """Existing and scan flags merged, for the calls the scan found something in; others stay."""
    scanned = scan.select("call_id").distinct()
    offset = existing.groupBy("call_id").agg(F.max("seq").alias("_top"))
    later = (scan.join(offset, "call_id", "left")
             .withColumn("seq", F.col("seq") + F.coalesce(F.col("_top") + 1, F.lit(0))).drop("_top"))
    touched = existing.join(scanned, "call_id", "left_semi")
    merged = merge_neighbours(touched.unionByName(later, allowMissingColumns=True))
    untouched = existing.join(scanned, "call_id", "left_anti").withColumn("flags_merged", F.lit(1).cast("bigint"))
    return merged.unionByName(untouched.select(*[c for c in merged.columns if c in untouched.columns]), allowMissingColumns=True)


def scan_flags_added(existing: DataFrame, merged: DataFrame, scan: DataFrame) -> DataFrame:
    """Findings the scan added per call, never below 0."""
    had = existing.groupBy("call_id").agg(F.count("*").alias("had"))
    has = merged.groupBy("call_id").agg(F.count("*").alias("has"))
    return (scan.select("call_id").distinct().join(had, "call_id", "left").join(has, "call_id", "left")
            .select("call_id", F.greatest(F.coalesce("has", F.lit(0)) - F.coalesce("had", F.lit(0)), F.lit(0)).alias("added")))


def _segments(rows: DataFrame, keys: list[str], low: str, high: str, width: int = scan.WIDTH) -> DataFrame:
    """(keys, seq, segment) of intervals: those that touch, one by the other, are one segment, named by its first (low, seq).

    Intervals of different segments share no turn.  An ordered scan: the state is how far the intervals reach and the segment they are
    in; a block's summary is how far it reaches and its last start by itself, which is a start if it lies beyond what came before.
    """
    def summarise(items):
        reach = low_at = seq_at = None
        for at, seq, end in items:
            if reach is None or at > reach:
                low_at, seq_at = at, seq
            reach = end if reach is None else max(reach, end)
        return reach, low_at, seq_at

    def enter(state, summary):
        reach, at, seq = summary
        if state is None or at > state[0]:
            return reach if state is None else max(reach, state[0]), at, seq
        return max(reach, state[0]), state[1], state[2]

    def apply(state, items):
        for at, seq, end in items:
            if state is None or at > state[0]:
                state = (end if state is None else max(end, state[0]), at, seq)
            else:
                state = (max(end, state[0]), state[1], state[2])
            yield seq, {"low": state[1], "seq": state[2]}

    named = rows.select(*keys, "seq", F.col(low).cast("bigint").alias("_lo"), F.col(high).cast("bigint").alias("_hi"))
    return scan.scanned(
        named, keys, "_lo", ["_lo", "seq"], ["_lo", "seq", "_hi"], width=width, summarise=summarise, enter=enter, apply=apply,
        summary="reach bigint, low bigint, seq bigint", state="reach bigint, low bigint, seq bigint", schema="seq bigint, segment struct<low bigint, seq bigint>")


def dedupe_flags(flags: DataFrame, width: int = scan.WIDTH) -> DataFrame:
    """Merge flags of one type that share a turn, each into the first it meets.

    Rows carry ``seq``, ``flag_type``, ``severity``, ``turn_index``, ``occurrences`` and
    ``occurrence_turns``.  Not a transitive closure: a flag that joins two findings extends the
    first of them only.  Findings of different types or of turn ranges that do not touch cannot
    meet, so the ordered fold runs per type and range of one call, as a stream that knows the first
    finding on each turn; a pile of flags on one turn needs no fold at all.  All other columns
    (quote, reason, source) are those of the kept finding.
    """
    turns = F.array_sort(F.array_distinct(F.concat(
        F.coalesce("occurrence_turns", F.array().cast("array<bigint>")), F.array("turn_index"))))
    rows = flags.withColumn("_turns", turns).withColumns({"_low": F.array_min("_turns"), "_high": F.array_max("_turns")})
    told = ["call_id", "flag_type", "seq"]
    rows = rows.join(_segments(rows, ["call_id", "flag_type"], "_low", "_high", width), told)
    keys = ["call_id", "flag_type", "segment"]
    rank = marks.severity_rank("severity")
    spans = rows.groupBy(*keys).agg((F.min("_low") == F.max("_high")).alias("_single"))
    rows = rows.join(spans, keys)
    pile = rows.where("_single").groupBy(*keys).agg(
        F.min("seq").alias("seq"), F.max(rank).alias("_rank"), F.min_by("turn_index", "seq").alias("turn_index"),
        F.min_by("_turns", "seq").alias("occurrence_turns"), F.max("occurrences").alias("occurrences"),
        F.count("*").alias("flags_merged"))

    def fold(_, items):
        findings, first_on = [], {}
        for seq, turn, level, times, own in items:
            met = [first_on[t] for t in own if t in first_on]
            if met:
                k = min(met)
                found = findings[k]
                found[4].update(own)
                found[2] = max(found[2], level)
                found[3] = max(found[3], times, len(found[4]))
                found[5] += 1
            else:
                k = len(findings)
                findings.append([seq, turn, level, times, set(own), 1])
            for t in own:
                first_on[t] = min(first_on.get(t, k), k)
        for seq, turn, level, times, own, merged in findings:
            yield seq, level, turn, sorted(own), times, merged

    listed = rows.where(~F.col("_single")).withColumns({"_rank": F.coalesce(rank, F.lit(-1)).cast("bigint"), "_times": F.coalesce("occurrences", F.lit(0)).cast("bigint"), "_at": F.col("turn_index").cast("bigint")})
    folded = scan.streamed(listed, keys, ["seq"], ["seq", "_at", "_rank", "_times", "_turns"],
                           "seq bigint, _rank bigint, turn_index bigint, occurrence_turns array<bigint>, occurrences bigint, flags_merged bigint", fold)
    merged = (pile.withColumn("occurrences", F.when(F.col("flags_merged") > 1, F.greatest("occurrences", F.lit(1)))
                              .otherwise(F.col("occurrences")).cast("bigint"))
              .unionByName(folded).withColumn("severity", marks.severity_name("_rank")).drop("_rank", "segment"))
    rest = [c for c in flags.columns if c not in merged.columns]
    if not rest:
        return merged
    return merged.join(flags.groupBy(*told).agg(F.min(F.struct(*rest)).alias("_rest")), told, "left").select(*merged.columns, "_rest.*")


def carry_over(report_flags: DataFrame, upstream: DataFrame, turns: DataFrame, dismissed: DataFrame,
               width: int = scan.WIDTH) -> DataFrame:
    """What becomes of each upstream flag that the report may have missed.

    ``upstream`` rows carry ``seq``, ``stated``, ``speaker``, ``phrase``, ``category``, ``severity``,
    ``reason`` and ``also_at_turns``; ``dismissed`` holds (call_id, turn).  ``fate`` is ``covered``,
    ``dismissed``, ``not_conduct`` or ``carried``.  A carried flag covers its turns for the flags
    after it.
    """
    sizes = turns.groupBy("call_id").agg(F.count("*").alias("_n"))
    spoken = turns.select("call_id", F.col("turn").cast("bigint").alias("turn"), F.col("text").alias("_text"))
    covered = (report_flags.select("call_id", F.explode(F.array_union(
        F.coalesce("occurrence_turns", F.array().cast("array<bigint>")), F.array("turn_index"))).alias("turn")).distinct()
        .withColumn("_covered", F.lit(True)))
    thrown = dismissed.select("call_id", "turn").distinct().join(covered.drop("_covered"), ["call_id", "turn"], "left_anti")
    tidy = upstream.withColumns({
        "phrase": text.strip(F.coalesce("phrase", F.lit(""))), "speaker": text.strip(F.coalesce("speaker", F.lit(""))),
        "category": F.lower(text.strip(F.coalesce("category", F.lit("")))),
        "severity": F.lower(text.strip(F.coalesce("severity", F.lit(""))))})
    tidy = tidy.withColumn("severity", F.when(F.col("severity").isin(list(K.SEVERITIES)), F.col("severity")).otherwise("medium"))
    found = locate_phrases(tidy, turns, out="_found").join(sizes, "call_id")
    inside = F.col("stated").isNotNull() & (F.col("stated") >= 0) & (F.col("stated") < F.col("_n"))
    turn = F.coalesce("_found", F.when(inside, F.col("stated")).otherwise(F.lit(0))).cast("bigint")
    found = found.withColumns({"anchored": F.col("_found").isNotNull(), "turn": turn})
    shift = F.when(F.col("stated").isNotNull(), F.col("turn") - F.col("stated")).otherwise(F.lit(0))
    others = F.transform(F.filter(F.coalesce("also_at_turns", F.array().cast("array<bigint>")), lambda t: t.isNotNull()),
                         lambda t: t + F.col("_shift"))
    legal = F.filter(others, lambda t: (t >= 0) & (t < F.col("_n")))
    found = found.withColumn("_shift", shift).withColumn(
        "occurrence_turns", F.array_sort(F.array_distinct(F.concat(F.array("turn"), legal))))
    out_1 = thrown.withColumn("_thrown", F.lit(True))
    out_2 = thrown.select("call_id", F.col("turn").alias("stated"), F.lit(True).alias("_thrown_stated"))
    judged = (found.join(covered, ["call_id", "turn"], "left").join(out_1, ["call_id", "turn"], "left")
              .join(out_2, ["call_id", "stated"], "left"))
    gone = F.coalesce("_thrown", "_thrown_stated", F.lit(False))
    judged = judged.withColumn("_state", F.when(F.coalesce("_covered", F.lit(False)), "covered").when(gone, "dismissed")
                               .when(~is_conduct("category"), "not_conduct").otherwise("open"))
    fates = _fates(judged.select("call_id", "seq", "turn", "occurrence_turns", "_state"), width)
    final = judged.join(fates, ["call_id", "seq"]).join(spoken, ["call_id", "turn"], "left")
    return final.select(
        "call_id", "seq", "stated", "turn", "anchored", "fate", flag_type("category").alias("flag_type"),
        "severity", F.coalesce(text.blank_to_null("phrase"), F.col("_text")).alias("verbatim"),
        F.coalesce(text.blank_to_null("reason"), F.lit("Flagged by the sentiment layer.")).alias("why_flagged"),
        F.lit("sentiment_layer").alias("source"), "occurrence_turns")


def _fates(judged: DataFrame, width: int) -> DataFrame:
    """(call_id, seq, fate) of judged flags, taken in order.

    The flags on one turn that may be carried are first reduced to the earliest, as no other can be;
    what is left is cut into turn ranges that do not touch, which do not affect each other, and each
    range is folded as a stream that knows the covered turns.
    """
    candidates = (judged.where(F.col("_state") == "open").groupBy("call_id", "turn")
                  .agg(F.min_by(F.struct("seq", "occurrence_turns"), "seq").alias("c"))
                  .select("call_id", "turn", F.col("c.seq").alias("seq"), F.col("c.occurrence_turns").alias("_occ"))
                  .withColumns({"_low": F.array_min("_occ"), "_high": F.array_max("_occ")}))
    ranges = candidates.join(_segments(candidates, ["call_id"], "_low", "_high", width), ["call_id", "seq"])

    def fold(_, items):
        covered = set()
        for seq, turn, own in items:
            if turn not in covered:
                covered.update(own)
                yield (seq,)

    taken = scan.streamed(ranges, ["call_id", "segment"], ["seq"], ["seq", "turn", "_occ"], "taken bigint", fold).select(
        "call_id", F.col("taken").alias("seq"), F.lit(True).alias("_taken"))
    covers = (judged.join(taken, ["call_id", "seq"], "left_semi").select("call_id", F.explode("occurrence_turns").alias("turn"), "seq")
              .groupBy("call_id", "turn").agg(F.min("seq").alias("_first_cover")))
    placed = judged.join(taken, ["call_id", "seq"], "left").join(covers, ["call_id", "turn"], "left")
    earlier = F.coalesce(F.col("_first_cover") < F.col("seq"), F.lit(False)) | (F.col("_state") == "open")
    return placed.select("call_id", "seq", F.when(F.col("_taken"), "carried").when(earlier, "covered").otherwise(F.col("_state")).alias("fate"))


def with_carried(report_flags: DataFrame, carried: DataFrame) -> DataFrame:
    """Report flags and, after them, the carried ones, in one order per call."""
    top = report_flags.groupBy("call_id").agg(F.max("seq").alias("_top"))
    more = (carried.where(F.col("fate") == "carried").join(top, "call_id", "left")
            .select("call_id", (F.col("seq") + F.coalesce(F.col("_top") + 1, F.lit(0))).alias("seq"), "flag_type", "severity",
                    "verbatim", F.col("turn").alias("turn_index"), F.lit(1).cast("bigint").alias("occurrences"),
                    "occurrence_turns", "why_flagged", "source"))
    return report_flags.unionByName(more, allowMissingColumns=True)


def unlinked_repeats(objections: DataFrame, turns: DataFrame, share: float = 0.5) -> DataFrame:
    """Earlier customer turns that say much the same as an objection but are not linked to it.

    ``objections``: call_id, objection_id, verbatim, turn_index, repeated_at_turns.
    """
    asked = objections.withColumn("tokens", F.array_sort(text.token_set("verbatim")))
    heard = turns.where(F.col("speaker") == "Customer").withColumn("tokens", F.array_sort(text.token_set("text")))
    # Equal token sets of a call are compared once.
    left = asked.select("call_id", "tokens").distinct().withColumn("_a", F.xxhash64("tokens"))
    right = heard.select("call_id", "tokens").distinct().withColumn("_b", F.xxhash64("tokens"))
    pairs = overlapping_pairs(left, right, "call_id", "_a", "_b", share=share)
    cited = F.array_append(F.coalesce("repeated_at_turns", F.array().cast("array<bigint>")), F.col("turn_index"))
    named = asked.select("call_id", "objection_id", "turn_index", cited.alias("_cited"), F.xxhash64("tokens").alias("_a"))
    said = heard.select("call_id", F.col("turn").cast("bigint").alias("turn"), F.xxhash64("tokens").alias("_b"))
    return (named.join(pairs, ["call_id", "_a"]).join(said, ["call_id", "_b"])
            .where((F.col("turn") <= F.col("turn_index")) & ~F.array_contains("_cited", F.col("turn")))
            .select("call_id", "objection_id", "turn_index", "turn", "overlap"))


def flag_totals(flags: DataFrame) -> DataFrame:
    """Flags per call and the types that void its score."""
    void = F.col("flag_type").isin(list(K.DISQUALIFYING_FLAG_TYPES))
    return flags.groupBy("call_id").agg(
        F.count("*").alias("flag_count"),
        F.array_sort(F.collect_set(F.when(void, F.col("flag_type")))).alias("disqualifying_flags")) \
        .withColumn("disqualified", F.size("disqualifying_flags") > 0)

