"""The steps a report goes through after the model: each takes the reports of all calls and returns them changed, with a log of what it did.

A report is held in parts that are rows of their own where they can be many (flags, objections, marks) and one nested document for the rest.
The order is fixed: each step goes by the turns the one before settled.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain import schemas
from talkgrain.operators import flags, quality, report, scorecard
from talkgrain.plans import ordered

LEDGER = [f.name for f in schemas.CARRY_FORWARD.fields]
REPEAT_SHARE = 0.5


class Reports(NamedTuple):
    """flags: seq, flag_type, severity, verbatim, turn_index, occurrences, occurrence_turns, why_flagged, source; objections: objection_id,
    objection_type, verbatim, turn_index, repeated_at_turns; documents: report, without those two; continuity: parent_id, is_follow_up,
    basis; relevance: is_relevant; card, flows, repeats: see ``scorecard``.  All by call_id."""

    flags: DataFrame
    objections: DataFrame
    documents: DataFrame
    continuity: DataFrame
    relevance: DataFrame
    card: DataFrame
    flows: DataFrame
    repeats: DataFrame


class Evidence(NamedTuple):
    """turns of the transcripts, what the sentiment layer flagged (upstream) and the audit dismissed, and the calls whose record was supplied."""

    turns: DataFrame
    upstream: DataFrame
    dismissed: DataFrame
    parents: DataFrame


Step = Callable[[Reports, Evidence], tuple[Reports, DataFrame]]


def entries(rows: DataFrame, step: str, code: str | Column, subject: Column, at: Column) -> DataFrame:
    """Log rows: (call_id, step, code, subject, at)."""
    return rows.select("call_id", F.lit(step).alias("step"), (F.lit(code) if isinstance(code, str) else code).alias("code"),
                       subject.cast("string").alias("subject"), at.cast("bigint").alias("at"))


def reanchor(reports: Reports, evidence: Evidence) -> tuple[Reports, DataFrame]:
    """Quotes point at the turn their words are in.  Log: the flag, and the turn it was moved to."""
    found = ordered.cut(flags.reanchor(reports.flags, evidence.turns))
    log = entries(found.where("moved"), "reanchor", "moved", F.col("seq"), F.col("turn_index"))
    return reports._replace(flags=found.drop("moved")), log


def carry_over(reports: Reports, evidence: Evidence) -> tuple[Reports, DataFrame]:
    """Nothing that was flagged upstream is lost.  Log: flags found nowhere, found in another turn, dismissed or no conduct, and how many were carried."""
    fates = ordered.cut(flags.carry_over(reports.flags, evidence.upstream, evidence.turns, evidence.dismissed))
    codes = F.array_compact(F.array(
        F.when(~F.col("anchored"), "unanchored"), F.when(F.col("anchored") & F.col("stated").isNotNull() & (F.col("turn") != F.col("stated")), "found_elsewhere"),
        F.when(F.col("fate").isin("dismissed", "not_conduct"), F.col("fate"))))
    single = entries(fates.select("call_id", "seq", "turn", F.explode(codes).alias("c")), "carry_over", F.col("c"), F.col("seq"), F.col("turn"))
    counts = fates.where("fate = 'carried'").groupBy("call_id").agg(F.count("*").alias("n"))
    return reports._replace(flags=flags.with_carried(reports.flags, fates)), single.unionByName(entries(counts, "carry_over", "carried", F.lit(None), F.col("n")))


def dedupe(reports: Reports, _: Evidence) -> tuple[Reports, DataFrame]:
    """One finding for each pattern.  Log: findings that took others in, and how many flags they are."""
    merged = ordered.cut(flags.dedupe_flags(ordered.cut(reports.flags)))
    log = entries(merged.where("flags_merged > 1"), "dedupe", "merged", F.col("seq"), F.col("flags_merged"))
    return reports._replace(flags=merged.drop("flags_merged")), log


def scrub(reports: Reports, _: Evidence) -> tuple[Reports, DataFrame]:
    """The sales summary cites no turns.  Log: the places that did."""
    clean = report.scrubbed(reports.documents, log="_scrubs")
    log = entries(clean.select("call_id", F.explode("_scrubs").alias("path")), "scrub", "citation_stripped", F.col("path"), F.lit(None))
    return reports._replace(documents=clean.drop("_scrubs")), log


def check_ledger(reports: Reports, _: Evidence) -> tuple[Reports, DataFrame]:
    """Log: calls that leave nothing for the next one to be marked against."""
    ledgers = reports.documents.select("call_id", *[F.col(f"report.sales_summary.carry_forward.{name}").alias(name) for name in LEDGER])
    return reports, entries(quality.ledger_warnings(ledgers, LEDGER), "check_ledger", F.col("warning"), F.lit(None), F.lit(None))


def check_repeats(reports: Reports, evidence: Evidence) -> tuple[Reports, DataFrame]:
    """Log: objections, and the earlier turns that say the same but are not linked."""
    found = flags.unlinked_repeats(reports.objections, evidence.turns, REPEAT_SHARE)
    return reports, entries(found, "check_repeats", "unlinked_repeat", F.col("objection_id"), F.col("turn"))


def check_bounds(reports: Reports, evidence: Evidence) -> tuple[Reports, DataFrame]:
    """Log: cited turns that the transcript does not have."""
    sizes = evidence.turns.groupBy("call_id").agg(F.count("*").alias("total_turns"))
    listed = lambda rows, *columns: [rows.select("call_id", F.explode(c).alias("turn")) for c in columns]
    parts = [report.citations(reports.documents).select("call_id", "turn"), reports.flags.select("call_id", F.col("turn_index").alias("turn")),
             reports.objections.select("call_id", F.col("turn_index").alias("turn")),
             *listed(reports.flags, "occurrence_turns"), *listed(reports.objections, "repeated_at_turns")]
    cited = parts[0]
    for part in parts[1:]:
        cited = cited.unionByName(part)
    return reports, entries(quality.beyond(cited, sizes), "check_bounds", "outside_transcript", F.lit(None), F.col("turn"))


def force_follow_up(reports: Reports, evidence: Evidence) -> tuple[Reports, DataFrame]:
    """A call whose parent's record was supplied is a follow-up.  Log: the calls that said otherwise."""
    forced = scorecard.force_follow_up(reports.continuity, evidence.parents)
    log = entries(forced.where("forced"), "force_follow_up", "forced", F.col("parent_id"), F.lit(None))
    return reports._replace(continuity=forced.drop("forced")), log


STEPS: list[Step] = [reanchor, carry_over, dedupe, scrub, check_ledger, check_repeats, check_bounds, force_follow_up]


def run(reports: Reports, evidence: Evidence, steps: list[Step] = STEPS) -> tuple[Reports, DataFrame]:
    """The reports after all steps, and the log of all of them."""
    evidence = evidence._replace(turns=ordered.cut(evidence.turns))
    log = None
    for step in steps:
        reports, said = step(reports, evidence)
        log = said if log is None else log.unionByName(said)
    return reports, log


def scored(reports: Reports) -> tuple[DataFrame, DataFrame]:
    """The score of each call, with its final flags, and the log of the marking."""
    marked = scorecard.marked_card(reports.card, reports.flows, reports.repeats, reports.continuity, reports.relevance)
    scores = scorecard.scores(marked, flags.flag_totals(reports.flags))
    by_mark = scorecard.score_warnings(marked)
    by_call = scorecard.call_warnings(scores, reports.repeats)
    log = entries(by_mark, "score", F.col("warning"), F.col("criterion"), F.lit(None)).unionByName(entries(by_call, "score", F.col("warning"), F.lit(None), F.col("n")))
    return scores, log
