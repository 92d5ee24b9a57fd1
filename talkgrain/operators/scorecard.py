"""The scorecard: one row per call and criterion, in the steps an audit is marked in.

Every step is a row expression or a grouping by (call, criterion); the section totals are one
aggregation by call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import marks, text


def criteria(spark: SparkSession) -> DataFrame:
    """The marking scheme as a table of nine fixed rows."""
    rows = [(section, name, full, list(bands)) for section, name, full, bands in K.MARKING_SCHEME]
    return spark.createDataFrame(rows, "section string, criterion string, full_marks long, bands array<long>")


def scheme_faults(scheme: DataFrame) -> DataFrame:
    """What is wrong with a marking scheme; no rows when it is sound."""
    sections = (scheme.groupBy("section").agg(F.sum("full_marks").alias("total"))
                .where(F.col("total") != K.SECTION_MARKS)
                .select(F.col("section").alias("subject"), F.lit("section is not worth ten").alias("fault")))
    ladder = (scheme.where((F.col("bands") != F.array_sort("bands")) | (F.element_at("bands", 1) != 0))
              .select(F.col("criterion").alias("subject"), F.lit("bands do not run upward from 0").alias("fault")))
    top = (scheme.where(F.element_at("bands", -1) != F.col("full_marks"))
           .select(F.col("criterion").alias("subject"), F.lit("top band is not full marks").alias("fault")))
    return sections.union(ladder).union(top)


def flow_marks(flows: DataFrame, checkpoints: tuple[str, ...] = tuple(K.FLOW_BREAK_TEXT)) -> DataFrame:
    """The flow line from its checkpoints: a band less for each that broke.

    With none of them reached there is nothing to judge: unreached, full marks.  A justification
    that does not name the break is replaced.
    """
    states = F.array(*[F.col(c) for c in checkpoints])
    broken = F.size(F.filter(states, lambda s: s == "broken"))
    never = F.size(F.filter(states, lambda s: s == "not_reached")) == len(checkpoints)
    table = F.array(*map(F.lit, K.FLOW_MARKS_BY_BREAKS))
    named = F.concat_ws("; ", *[F.when(F.col(c) == "broken", F.lit(K.FLOW_BREAK_TEXT[c])) for c in checkpoints])
    says = text.contains_any(F.lower(F.coalesce("justification", F.lit(""))), K.FLOW_BREAK_WORDS)
    rewrite = (broken > 0) & ~never & ~says
    return flows.withColumns({
        "flow_reached": ~never, "flow_breaks": broken.cast("bigint"),
        "flow_awarded": F.when(never, K.CRITERION_MAX[K.FLOW_CRITERION]).otherwise(F.element_at(table, broken + 1)).cast("bigint"),
        "justification": F.when(rewrite, F.concat(F.lit(K.FLOW_BREAK_PREFIX), named, F.lit("."))).otherwise(F.col("justification"))})


def apply_flow(card: DataFrame, flows: DataFrame) -> DataFrame:
    """The flow line takes the computed mark.  The join goes by call, as those after it do, so that a card is shuffled and sorted once."""
    marked = flow_marks(flows).select("call_id", "flow_reached", "flow_awarded")
    lines, own = card.alias("c"), marked.alias("f")
    joined = (lines.join(own, (F.col("c.call_id") == F.col("f.call_id")) & (F.col("c.criterion") == F.lit(K.FLOW_CRITERION)), "left")
              .select("c.*", "f.flow_reached", "f.flow_awarded"))
    return joined.withColumns({
        "flow_changed": F.coalesce(F.col("flow_reached") & (F.col("flow_awarded") != F.col("awarded")), F.lit(False)),
        "reached": F.coalesce("flow_reached", "reached"), "awarded": F.coalesce("flow_awarded", "awarded"),
    }).drop("flow_reached", "flow_awarded")


def repeat_counts(repeats: DataFrame) -> DataFrame:
    """A row per call: how often each criterion of the scheme is repeated, in the scheme's order."""
    counts = repeats.groupBy("call_id").agg(*[F.count_if(F.col("criterion") == name).alias(name) for name in K.CRITERIA])
    return counts.select("call_id", F.array(*K.CRITERIA).alias("_counts"))


def apply_repetitions(card: DataFrame, repeats: DataFrame, continuity: DataFrame) -> DataFrame:
    """A follow-up's criterion steps down one band for each repeat of the call before.

    Nothing is taken off a criterion that was not reached, or on a call that is not a follow-up.
    ``repeat_on_unreached`` keeps that there was a repeat on a criterion not reached at this point.
    Repeats of a criterion that the scheme does not have count nowhere.
    """
    follow = continuity.select("call_id", "is_follow_up")
    place = F.create_map(*[x for k, name in enumerate(K.CRITERIA) for x in (F.lit(name), F.lit(k))])
    joined = (card.join(repeat_counts(repeats), "call_id", "left").join(follow, "call_id", "left")
              .withColumn("repeats", F.coalesce(F.get("_counts", F.try_element_at(place, "criterion")), F.lit(0).cast("bigint"))).drop("_counts"))
    applies = F.coalesce("is_follow_up", F.lit(False)) & F.col("reached") & (F.col("repeats") > 0)
    stepped = (joined.withColumn("_before", F.least("awarded", marks.full_marks("criterion")))
               .withColumn("_after", F.when(applies, marks.step_down("criterion", "_before", "repeats"))))
    off = F.coalesce(F.col("_before") - F.col("_after"), F.lit(0).cast("bigint"))
    idle = F.coalesce("is_follow_up", F.lit(False)) & ~F.col("reached") & (F.col("repeats") > 0)
    return (stepped.withColumns({"deduction": off, "repeat_on_unreached": F.coalesce(idle, F.lit(False))})
            .withColumn("awarded", F.when(F.col("deduction") > 0, F.col("_after")).otherwise(F.col("awarded")))
            .drop("_before", "_after"))


def apply_relevance(card: DataFrame, relevance: DataFrame) -> DataFrame:
    """On an irrelevant lead the two product lines are unreached and take full marks."""
    joined = card.join(relevance.select("call_id", "is_relevant"), "call_id", "left")
    free = ~F.coalesce("is_relevant", F.lit(True)) & F.col("criterion").isin(list(K.NOT_APPLICABLE_IF_IRRELEVANT))
    full = marks.full_marks("criterion")
    return joined.withColumn("not_applicable", free).withColumns({
        "relevance_changed": F.col("not_applicable") & (F.col("awarded") != full),
        "reached": ~F.col("not_applicable") & F.col("reached"),
        "awarded": F.when(F.col("not_applicable"), full).otherwise(F.col("awarded"))})


def apply_defaults(card: DataFrame) -> DataFrame:
    """Unreached lines take full marks; a mark above the maximum is clamped."""
    full = marks.full_marks("criterion")
    return card.withColumns({
        "given": F.col("awarded"), "defaulted": ~F.col("reached") & (F.col("awarded") != full),
        "clamped": F.col("reached") & (F.col("awarded") > full)}).withColumn(
        "awarded", F.when(~F.col("reached"), full).otherwise(F.least("given", full)))


def marked_card(card: DataFrame, flows: DataFrame, repeats: DataFrame, continuity: DataFrame,
                relevance: DataFrame) -> DataFrame:
    """All steps in their fixed order: flow, repeats, relevance, defaults and clamps."""
    flowed = apply_flow(card, flows)
    return apply_defaults(apply_relevance(apply_repetitions(flowed, repeats, continuity), relevance))


def score_warnings(marked: DataFrame) -> DataFrame:
    """One row per change a mark went through."""
    notice = ~F.col("reached") & F.col("criterion").isin(list(K.NOTICE_IF_UNREACHED))
    codes = F.array_compact(F.array(
        F.when(F.col("flow_changed"), "flow_computed"), F.when(F.col("deduction") > 0, "repeat_deducted"),
        F.when(F.col("repeat_on_unreached"), "repeat_on_unreached"), F.when(F.col("relevance_changed"), "not_applicable"),
        F.when(notice, "unreached_with_notice"), F.when(F.col("defaulted"), "unreached_full_marks"),
        F.when(F.col("clamped"), "clamped")))
    return marked.select("call_id", "criterion", F.explode(codes).alias("warning"))


def call_warnings(scores: DataFrame, repeats: DataFrame) -> DataFrame:
    """(call_id, warning, n) on whole calls: repeats listed on a call that is no follow-up, a lead that was never a buyer, a voided score,
    flags that cost nothing."""
    counts = repeats.groupBy("call_id").agg(F.count("*").alias("_repeats"))
    rows = scores.join(counts, "call_id", "left")
    told = lambda test, code, n: F.when(test, F.struct(F.lit(code).alias("warning"), n.cast("bigint").alias("n")))
    void = F.coalesce("disqualified", F.lit(False))
    codes = F.array_compact(F.array(
        told(~F.coalesce("is_follow_up", F.lit(False)) & (F.col("_repeats") > 0), "repeats_without_follow_up", F.col("_repeats")),
        told(F.coalesce("irrelevant_lead", F.lit(False)), "irrelevant_lead", F.lit(None)),
        told(void, "score_voided", F.col("flag_count")), told(~void & (F.col("flag_count") > 0), "flags_recorded", F.col("flag_count"))))
    return rows.select("call_id", F.explode(codes).alias("w")).select("call_id", "w.*")


def section_totals(marked: DataFrame) -> DataFrame:
    return (marked.withColumn("section", marks.section_of("criterion")).groupBy("call_id", "section")
            .agg(F.sum("awarded").alias("section_marks"), F.sum(marks.full_marks("criterion")).alias("section_max")))


def scores(marked: DataFrame, flag_totals: DataFrame, total: int = K.TOTAL_MARKS) -> DataFrame:
    """Earned marks on a scale of 100.  Flags cost nothing; a disqualifying one voids the score."""
    summed = marked.groupBy("call_id").agg(
        F.sum("awarded").alias("earned_marks"), F.sum("deduction").alias("repetition_deductions"),
        F.count_if("not_applicable").alias("not_applicable_criteria"),
        F.first("is_follow_up").alias("is_follow_up"), (~F.first("is_relevant")).alias("irrelevant_lead"))
    joined = summed.join(flag_totals, "call_id", "left")
    before = F.round(F.col("earned_marks") * 100.0 / total, 1)
    return joined.withColumns({
        "max_marks": F.lit(total).cast("bigint"), "score_before_flags": before,
        "flag_count": F.coalesce("flag_count", F.lit(0).cast("bigint")),
        "disqualified": F.coalesce("disqualified", F.lit(False))}).withColumn(
        "overall_score_100", F.when(F.col("disqualified"), 0.0).otherwise(F.col("score_before_flags")))


def marks_map(marked: DataFrame) -> DataFrame:
    """Criterion marks of each call as a map of nine fixed names."""
    by_name = marked.groupBy("call_id").agg(*[
        F.max(F.when(F.col("criterion") == name, F.col("awarded"))).alias(name) for name in K.CRITERIA])
    pairs = [x for name in K.CRITERIA for x in (F.lit(name), F.col(name))]
    return by_name.select("call_id", F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull()).alias("criterion_marks"))


def force_follow_up(continuity: DataFrame, parents: DataFrame) -> DataFrame:
    """A call whose parent's record was supplied is a follow-up, whatever its transcript says."""
    known = parents.select(F.col("call_id").alias("parent_id"), F.lit(True).alias("_has"))
    joined = continuity.join(known, "parent_id", "left")
    forced = F.coalesce("_has", F.lit(False)) & ~F.coalesce("is_follow_up", F.lit(False))
    default = F.concat(F.lit("The previous call ("), "parent_id", F.lit(
        ") was audited on this student; the transcript itself carries no reference back to it."))
    return joined.withColumn("forced", forced).withColumns({
        "is_follow_up": F.coalesce("is_follow_up", F.lit(False)) | F.col("forced"),
        "basis": F.when(F.col("forced"), F.coalesce(text.blank_to_null("basis"), default)).otherwise(F.col("basis"))}).drop("_has")


def synthetic_audits(call_ids: DataFrame, call_id: Column | str = "call_id") -> DataFrame:
    """A stand-in audit per call, fixed by a hash of its id; for wiring and load tests."""
    value = F.col(call_id) if isinstance(call_id, str) else call_id
    seed = F.conv(F.substring(F.sha2(value.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return call_ids.withColumn("_seed", seed).withColumns({
        "score": F.round(F.lit(55.0) + (F.col("_seed") % 400) / 10.0, 1),
        "flag_count": F.col("_seed") % 4,
        "talk_ratio": F.round(F.lit(0.3) + (F.col("_seed") % 50) / 100.0, 4),
        "total_turns": F.lit(20) + F.col("_seed") % 40,
        "conversion_probability": F.round((F.col("_seed") % 90) / 100.0, 2),
        "outcome": F.element_at(F.array(*map(F.lit, (
            "committed", "interested_no_commitment", "callback_requested", "not_interested", "demo_agreed"))),
            (F.col("_seed") % 5 + 1).cast("int"))}).drop("_seed")
