"""Tokens, turns and talk metrics of a conversation.

Nothing here gathers a whole call: ordered steps go through ``plans.ordered``, counters through
partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import marks, text
from talkgrain.plans import ordered
from talkgrain.plans.ranking import middle_values

CALL = ["call_id"]


def clean_turns(turns: DataFrame, swap: bool = False, drop_fillers: bool = False, speaker: str = "speaker",
                pos: str = "pos") -> DataFrame:
    """Roles normalised, text tidied, empty turns and (optionally) fillers dropped."""
    tidy = turns.withColumns({"role": text.normalise_role(speaker, swap), "text": text.clean_text("text")})
    tidy = tidy.where(F.col("text") != "")
    return tidy.where(~text.is_filler("text")) if drop_fillers else tidy


def merged_turns(cleaned: DataFrame, pos: str = "pos", width: int | None = ordered.AUTO) -> DataFrame:
    """Back-to-back turns of one role as one: texts joined, first start, last end."""
    timed = [c for c in ("start_ms", "end_ms") if c in cleaned.columns]

    def build(rows: DataFrame, width: int | None) -> DataFrame:
        numbered = ordered.islands(rows, CALL, pos, width, label="role")
        aggs = [F.min_by("role", pos).alias("role"), F.count("*").alias("merged_turns"), F.min(pos).alias("first_pos")]
        if timed:
            aggs += [F.min_by(F.struct("start_ms"), pos).alias("_s"), F.max_by(F.struct("end_ms"), pos).alias("_e")]
        merged = ordered.joined_text(numbered, [*CALL, "island"], pos, F.col("text"), "text", aggs, width=width)
        if timed:
            merged = merged.withColumns({"start_ms": F.col("_s.start_ms"), "end_ms": F.col("_e.end_ms")}).drop("_s", "_e")
        return merged.withColumnRenamed("island", "turn")

    return ordered.by_size(cleaned, CALL, build, width)


def utterances(tokens: DataFrame, max_gap_ms: int, width: int | None = ordered.AUTO) -> DataFrame:
    """Tokens to utterances: a new one on another speaker or a silence longer than ``max_gap_ms``.

    Blank tokens stay inside an utterance and never begin one.  The end of an utterance is that of
    its last token with one, so after an utterance that so far has no end no silence can be seen:
    of the tokens that would be measured against one end, only the first opens an utterance.
    """
    def build(rows: DataFrame, width: int | None) -> DataFrame:
        spoken = (rows.withColumn("_blank", text.strip("text") == "").withColumn("speaker", F.coalesce("speaker", F.lit("unknown"))))
        heard = F.when(~F.col("_blank"), F.col("speaker"))
        # A blank token takes the speaker before it, so that it breaks no run.
        carried = ordered.running_max(spoken, CALL, "pos", F.when(heard.isNotNull(), F.struct("pos", "speaker")), "_prior", width)
        voiced = carried.withColumn("_voice", F.coalesce(heard, F.col("_prior.speaker")))
        runs = ordered.islands(voiced.drop("_prior"), CALL, "pos", width, label="_voice", out="run")
        ended = F.when(~F.col("_blank") & F.col("end_ms").isNotNull(), F.struct("pos", "run", "end_ms"))
        known = ordered.running_max(runs, CALL, "pos", ended, "last", width)
        same = F.col("last.run") == F.col("run")
        silent = ~F.col("_blank") & F.coalesce(same & (F.col("start_ms") - F.col("last.end_ms") > max_gap_ms), F.lit(False))
        flagged = known.withColumn("_silent", silent)
        # Only the first silence after each end opens an utterance.
        fired = ordered.running_max(flagged, CALL, "pos", F.when(F.col("_silent"), F.struct("pos", F.col("last.pos").alias("after"))), "_fired", width)
        first = F.col("_silent") & ~F.coalesce(F.col("_fired.after") == F.col("last.pos"), F.lit(False))
        opened = ordered.islands(fired.withColumn("_opens", first), CALL, "pos", width, starts="_opens", out="_gaps")
        inside = opened.where(F.col("_voice").isNotNull())
        grouped = ordered.joined_text(
            inside, [*CALL, "run", "_gaps"], "pos", F.col("text"), "text",
            [F.min_by("_voice", "pos").alias("speaker_id"),
             F.min_by(F.struct("start_ms"), F.when(~F.col("_blank"), F.col("pos"))).alias("_s"),
             F.max_by("end_ms", F.when(~F.col("_blank") & F.col("end_ms").isNotNull(), F.col("pos"))).alias("end_ms"),
             F.min(F.when(~F.col("_blank"), F.col("pos"))).alias("first_pos")], separator="", width=width)
        tidy = (grouped.withColumns({"text": text.collapse_space("text"), "start_ms": F.col("_s.start_ms")})
                .where(F.col("text") != "").drop("_s", "run", "_gaps"))
        return ordered.dense_index(tidy, CALL, "first_pos", "utterance", width)

    return ordered.by_size(tokens, CALL, build, width)


def speaker_scores(spoken: DataFrame, plus: tuple[str, ...] = K.EMPLOYEE_MARKERS,
                   minus: tuple[str, ...] = K.CUSTOMER_MARKERS, pos: str = "utterance") -> DataFrame:
    """Per speaker of a call: vocabulary score, characters, utterances, first time."""
    return spoken.groupBy("call_id", "speaker_id").agg(
        F.sum(text.marker_hits("text", plus, minus)).alias("marker_score"),
        F.sum(F.length("text").cast("bigint")).alias("chars"), F.count("*").alias("utterances"),
        F.min_by(F.struct("start_ms"), pos)["start_ms"].alias("first_ms"), F.min(pos).alias("first_pos"))


def employee_speaker(scores: DataFrame, forced: DataFrame | None = None) -> DataFrame:
    """The employee of each call.

    The best vocabulary score decides.  When two share it, whoever said most in the whole call is
    taken, even one with a lower score.  ``forced(call_id, speaker_id)`` overrides.
    """
    leads = F.col("marker_score") == F.col("_top")
    topped = scores.where(F.col("call_id").isNotNull()).withColumn("_top", F.max("marker_score").over(Window.partitionBy("call_id")))
    leaders = topped.groupBy("call_id").agg(
        F.count_if(leads).alias("leaders"), F.min(F.when(leads, F.col("speaker_id"))).alias("leader"),
        F.max_by("speaker_id", F.struct("chars", -F.col("first_pos"))).alias("talkiest")).where(F.col("leaders") > 0)
    pick = F.when(F.col("leaders") == 1, F.col("leader")).otherwise(F.col("talkiest"))
    if forced is None:
        return leaders.select("call_id", pick.alias("employee_speaker"), F.lit("auto").alias("detection"))
    named = forced.select("call_id", F.col("speaker_id").alias("_forced"))
    return leaders.join(named, "call_id", "left").select(
        "call_id", F.coalesce("_forced", pick).alias("employee_speaker"),
        F.when(F.col("_forced").isNotNull(), "manual").otherwise("auto").alias("detection"))


def assign_roles(spoken: DataFrame, employees: DataFrame) -> DataFrame:
    """The chosen speaker is the Employee, every other a Customer; times get a readable form."""
    role = F.when(F.col("speaker_id") == F.col("employee_speaker"), "Employee").otherwise("Customer")
    return spoken.join(employees, "call_id").withColumns({
        "speaker": role, "start": text.clock("start_ms"), "end": text.clock("end_ms")})


def speaker_mapping(scores: DataFrame, employees: DataFrame) -> DataFrame:
    role = F.when(F.col("speaker_id") == F.col("employee_speaker"), "Employee").otherwise("Customer")
    return scores.join(employees, "call_id").select("call_id", "speaker_id", role.alias("role"), "detection")


def metadata(turns: DataFrame) -> DataFrame:
    """Turns and words per side, and the employee's share of the words."""
    employee = F.col("speaker") == "Employee"
    customer = F.col("speaker") == "Customer"
    words = text.word_count("text")
    counted = turns.groupBy("call_id").agg(
        F.count("*").alias("total_turns"), F.count_if(employee).alias("employee_turns"),
        F.count_if(customer).alias("customer_turns"),
        F.sum(F.when(employee, words).otherwise(0)).alias("employee_words"),
        F.sum(F.when(customer, words).otherwise(0)).alias("customer_words"))
    ratio = F.try_divide(F.col("employee_words"), F.col("employee_words") + F.col("customer_words"))
    return counted.withColumn("talk_ratio", F.coalesce(F.round(ratio, 4), F.lit(0.0)))


def longest_monologue(turns: DataFrame, pos: str = "turn", width: int | None = ordered.AUTO) -> DataFrame:
    """Most words the employee spoke with no customer turn between."""
    sized = turns.select("call_id", pos, "speaker", text.word_count("text").alias("words"))

    def build(rows: DataFrame, width: int | None) -> DataFrame:
        runs = ordered.islands(rows, CALL, pos, width, label="speaker")
        totals = runs.groupBy("call_id", "island").agg(F.min("speaker").alias("speaker"), F.sum("words").alias("words"))
        spoken = F.when(F.col("speaker") == "Employee", F.col("words"))
        return totals.groupBy("call_id").agg(F.coalesce(F.max(spoken), F.lit(0)).alias("longest_monologue_words"))

    return ordered.by_size(sized, CALL, build, width)


_SEGMENT_ORDER = ["start_ms", "pos"]
_SEGMENT_BLOCK_MS = 3_600_000


def floor_changes(segments: DataFrame, width: int | None = ordered.AUTO) -> DataFrame:
    """One row per customer segment and, before the first, for the opening: what followed it.

    ``customer_ms`` is its start (NULL for the opening), ``employee_ms`` the employee's first start
    after it, ``next_ms`` and ``prev_ms`` the neighbouring customer starts, ``last_end_ms`` the end
    of the last segment before the next customer one.
    """
    is_customer = F.col("speaker") != "Employee"

    def build(rows: DataFrame, width: int | None) -> DataFrame:
        span = None if width is None else _SEGMENT_BLOCK_MS
        counted = ordered.running_sum(rows, CALL, "start_ms", is_customer.cast("bigint"), "customers", span, _SEGMENT_ORDER)
        stops = counted.groupBy("call_id", "customers").agg(
            F.min(F.when(is_customer, F.col("start_ms"))).alias("customer_ms"),
            F.min(F.when(~is_customer, F.col("start_ms"))).alias("employee_ms"),
            F.max_by("end_ms", F.struct(*_SEGMENT_ORDER)).alias("last_end_ms"))
        return ordered.neighbours(stops, CALL, "customers", F.col("customer_ms"), 1, 1, width)

    return ordered.by_size(segments, CALL, build, width).withColumns({
        "prev_ms": F.get("earlier", F.lit(0)), "next_ms": F.get("later", F.lit(0))}).drop("earlier", "later")


def _stretch_ms() -> Column:
    return F.greatest(F.coalesce("next_ms", "last_end_ms") - F.col("employee_ms"), F.lit(0))


def employee_stretches(segments: DataFrame) -> DataFrame:
    """From the employee's first word to the customer's next, or to the end of the last segment."""
    return floor_changes(segments).where(F.col("employee_ms").isNotNull()).select(
        "call_id", F.col("customers").alias("stretch"), F.col("employee_ms").alias("from_ms"), _stretch_ms().alias("stretch_ms"))


def customer_gaps(segments: DataFrame) -> DataFrame:
    """Time from each customer segment's start to the next one's."""
    return _gaps(floor_changes(segments))


def _gaps(stops: DataFrame) -> DataFrame:
    return stops.where(F.col("prev_ms").isNotNull()).select("call_id", "customers", (F.col("customer_ms") - F.col("prev_ms")).alias("gap_ms"))


def talk_pattern(segments: DataFrame) -> DataFrame:
    """Stretches, contributions and the median customer gap of each call with segments."""
    stops = floor_changes(segments)
    length = F.when(F.col("employee_ms").isNotNull(), _stretch_ms())
    counted = stops.groupBy("call_id").agg(
        F.count("customer_ms").alias("contributions"), F.coalesce(F.max(length), F.lit(0).cast("bigint")).alias("longest_ms"),
        *[F.count_if(F.coalesce(length > sec * 1000, F.lit(False))).alias(f"over_{sec}s") for sec in (45, 60, 90)])
    middle = middle_values(_gaps(stops), CALL, "gap_ms").select(
        "call_id", F.floor((F.col("low_mid") + F.col("high_mid")) / 2).cast("bigint").alias("median_gap_ms"))
    return counted.join(middle, "call_id", "left").withColumn("two_way_advice", marks.two_way_advice("over_90s"))


def describe_pattern(patterns: DataFrame) -> DataFrame:
    """The talk pattern in words, the deciding figure first."""
    gap = F.when(F.col("median_gap_ms").isNotNull(), F.concat(
        F.lit("usually about "), text.spoken_duration("median_gap_ms"), F.lit(" between contributions")))
    lines = F.concat_ws(
        "\n", F.format_string("stretches over 90 sec: %d", "over_90s"),
        F.concat(F.lit("longest unbroken stretch: "), text.spoken_duration("longest_ms")),
        F.format_string("stretches over 45 sec: %d; over 60 sec: %d", "over_45s", "over_60s"),
        F.format_string("customer spoke %d time(s)", "contributions"), gap)
    return patterns.withColumn("description", lines)


def context_frames(turns: DataFrame, before: int = K.CONTEXT_TURNS, after: int = K.LOOKAHEAD_TURNS,
                   width: int | None = ordered.AUTO) -> DataFrame:
    """Each turn with the turns around it, numbered from 1; ``turn`` is the dense index from 0."""
    line = F.concat((F.col("turn") + 1).cast("string"), F.lit(". "), "speaker", F.lit(": "), "text")
    framed = ordered.by_size(turns, CALL, lambda rows, width: ordered.neighbours(rows, CALL, "turn", line, before, after, width), width)
    return framed.withColumns({"context_before": F.array_join("earlier", "\n"), "target": line,
                               "context_after": F.array_join("later", "\n")}).drop("earlier", "later")


def scan_targets(turns: DataFrame) -> DataFrame:
    """Employee turns worth a conduct check."""
    return turns.where(text.is_employee("speaker") & ~text.is_backchannel("text"))


def scan_counts(turns: DataFrame) -> DataFrame:
    employee = text.is_employee("speaker")
    return turns.groupBy("call_id").agg(
        F.count_if(employee).alias("employee_turns"),
        F.count_if(employee & ~text.is_backchannel("text")).alias("targets"),
        F.count_if(employee & text.is_backchannel("text")).alias("skipped"))


def chunk_starts(total: Column, size: int = K.CHUNK_TURNS, overlap: int = K.CHUNK_OVERLAP_TURNS) -> Column:
    """Starts of the overlapping chunks that cover ``total`` turns."""
    step = max(1, size - overlap)
    last = F.ceil(F.greatest(total - size, F.lit(0)) / step).cast("bigint") * step
    return F.sequence(F.lit(0).cast("bigint"), last, F.lit(step).cast("bigint"))


def chunks(turns: DataFrame, size: int = K.CHUNK_TURNS, overlap: int = K.CHUNK_OVERLAP_TURNS) -> DataFrame:
    """Turns with the start of every chunk they are in; ``turn`` is the dense index from 0.

    A turn works out its own chunks, so there is no range join and no list of a call's chunks.
    """
    step = max(1, size - overlap)
    totals = turns.groupBy("call_id").agg(F.count("*").alias("total_turns"))
    last = F.ceil(F.greatest(F.col("total_turns") - size, F.lit(0)) / step).cast("bigint")
    low = F.greatest(F.ceil((F.col("turn") - size + 1) / step), F.lit(0)).cast("bigint")
    high = F.least(F.floor(F.col("turn") / step), last).cast("bigint")
    placed = turns.join(totals, "call_id").withColumn("_c", F.explode(F.sequence(low, high)))
    return placed.withColumn("chunk_start", F.col("_c") * step).drop("_c")


def numbered_transcript(turns: DataFrame, style: str = "zero", width: int | None = ordered.AUTO) -> DataFrame:
    """The whole call as one numbered text: ``[0] S: t`` or ``1. S: t``."""
    if style == "zero":
        line = F.concat(F.lit("["), F.col("turn").cast("string"), F.lit("] "), "speaker", F.lit(": "), "text")
    else:
        line = F.concat((F.col("turn") + 1).cast("string"), F.lit(". "), "speaker", F.lit(": "), "text")
    return ordered.by_size(turns, CALL, lambda rows, width: ordered.joined_text(
        rows, CALL, "turn", line, "transcript", [F.count("*").alias("total_turns")], "\n", width), width)


def transcript_size(turns: DataFrame) -> DataFrame:
    """Token estimate and mode of a call from the rendered length, without rendering it."""
    line = F.length("text") + F.length("speaker") + F.length(F.col("turn").cast("string")) + 6
    sized = turns.groupBy("call_id").agg((F.sum(line) - 1).alias("chars"))
    return sized.withColumn("tokens", text.token_estimate("chars")).withColumn("mode", text.processing_mode("tokens"))


def aligned_display(clean: DataFrame, timed: DataFrame) -> DataFrame:
    """Cleaned turns with times from the re-merged utterances, where both have as many turns."""
    n_clean = clean.groupBy("call_id").agg(F.count("*").alias("_nc"))
    n_timed = timed.groupBy("call_id").agg(F.count("*").alias("_nt"))
    same = n_clean.join(n_timed, "call_id").where(F.col("_nc") == F.col("_nt")).select("call_id", F.lit(True).alias("_same"))
    clock = (timed.where(F.col("start_ms").isNotNull()).join(same, "call_id")
             .select("call_id", "turn", "start_ms", "end_ms"))
    return clean.join(clock, ["call_id", "turn"], "left")
