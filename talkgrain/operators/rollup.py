"""Day totals at floor, team and agent scope, and reads over spans of days.

Every stored number is additive or an extreme.  Calls are aggregated once, to the agent grain;
teams and the floor are sums of that small table, so the calls are shuffled once and are never
multiplied by the three scopes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.functions import marks, timing
from talkgrain.operators.calls import is_review
from talkgrain.plans.ordered import cut
from talkgrain.plans.ranking import rank_descending

GRAIN = ["date_key", "team", "agent_key"]
SUMS = ("total_calls", "audited_calls", "scored_calls", "total_flags", "flagged_calls", "fatal_calls",
        "review_calls", "score_sum", "total_duration_sec", "high_calls", "medium_calls", "low_calls")


def agent_days(calls: DataFrame) -> DataFrame:
    """Totals per day, team and agent of calls that carry ``team`` and ``agent_key``."""
    flags = F.coalesce("flag_count", F.lit(0).cast("bigint"))
    severity = F.upper("audit_status")
    return (calls.withColumn("date_key", timing.date_key("started_at")).groupBy(*GRAIN).agg(
        F.count("*").alias("total_calls"),
        F.count_if(F.col("processing_status") == "PROCESSED").alias("audited_calls"),
        F.count("score").alias("scored_calls"),
        F.sum(flags).alias("total_flags"),
        F.count_if(flags > 0).alias("flagged_calls"),
        F.count_if(F.coalesce("disqualified", F.lit(False))).alias("fatal_calls"),
        F.count_if(is_review()).alias("review_calls"),
        F.coalesce(F.sum("score"), F.lit(0.0)).alias("score_sum"),
        F.max("score").alias("score_max"), F.min("score").alias("score_min"),
        F.coalesce(F.sum("duration_sec"), F.lit(0).cast("bigint")).alias("total_duration_sec"),
        F.count_if(severity == "HIGH").alias("high_calls"),
        F.count_if(severity == "MEDIUM").alias("medium_calls"),
        F.count_if(severity == "LOW").alias("low_calls")))


def agent_labels(calls: DataFrame) -> DataFrame:
    """Name and extension on an agent's latest call of each day.

    Kept apart from the totals: text in an aggregate would keep those from being hashed.
    """
    label = F.max_by(F.struct("agent_name", "agent_extension"), F.struct("started_at", "call_id")).alias("_l")
    found = calls.withColumn("date_key", timing.date_key("started_at")).groupBy(*GRAIN).agg(label)
    return found.select(*GRAIN, F.col("_l.agent_name").alias("label_name"), F.col("_l.agent_extension").alias("label_extension"))


def with_labels(rollups: DataFrame, calls: DataFrame) -> DataFrame:
    """Roll-up rows with the labels of the agent scope."""
    return rollups.join(agent_labels(calls), GRAIN, "left")


def _scope() -> Column:
    level = F.grouping_id()
    return F.when(level == 3, "OVERALL").when(level == 1, "TEAM").otherwise("AGENT")


def _sets(df: DataFrame, more: list[str] | None = None):
    """Floor, team and agent grouping sets, each with the extra columns."""
    extra = more or []
    sets = [["date_key", *extra], ["date_key", "team", *extra], ["date_key", "team", "agent_key", *extra]]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in ["date_key", *extra, "team", "agent_key"]])


def rollup_key(scope: Column | str = "scope") -> Column:
    value = F.col(scope) if isinstance(scope, str) else scope
    return (F.when(value == "OVERALL", "OVERALL")
            .when(value == "TEAM", F.concat_ws("#", value, "team"))
            .otherwise(F.concat_ws("#", value, "team", "agent_key")))


def split_rollup_key(rows: DataFrame, pk: str = "pk") -> DataFrame:
    """Scope, team and agent key back out of a key; empty where the key has another shape."""
    parts = F.split(pk, "#")
    head, size = F.get(parts, F.lit(0)), F.size(parts)
    team_ok, agent_ok = (head == "TEAM") & (size == 2), (head == "AGENT") & (size == 3)
    return rows.withColumns({
        "scope": F.when((head == "OVERALL") | team_ok | agent_ok, head).otherwise(""),
        "team": F.when(team_ok | agent_ok, F.get(parts, F.lit(1))).otherwise(""),
        "agent_key": F.when(agent_ok, F.get(parts, F.lit(2))).otherwise("")})


def day_rollup(agent_level: DataFrame) -> DataFrame:
    """One row per day and scope from the agent grain."""
    rolled = _sets(agent_level).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("score_max").alias("score_max"), F.min("score_min").alias("score_min"),
        _scope().alias("scope"))
    return rolled.withColumns({"score_sum": F.round("score_sum", 4), "pk": rollup_key()})


def severity_map(rows: DataFrame) -> DataFrame:
    """HIGH, MEDIUM and LOW counts as a map; a zero has no entry."""
    counts = F.create_map(F.lit("HIGH"), F.col("high_calls"), F.lit("MEDIUM"), F.col("medium_calls"),
                          F.lit("LOW"), F.col("low_calls"))
    return rows.withColumn("severity_calls", F.map_filter(counts, lambda _k, v: v > 0))


def status_counts(calls: DataFrame) -> DataFrame:
    """Calls per day, scope and status, long."""
    status = F.coalesce(F.nullif("processing_status", F.lit("")), F.lit("UNKNOWN"))
    base = (calls.withColumns({"date_key": timing.date_key("started_at"), "status": status})
            .groupBy(*GRAIN, "status").agg(F.count("*").alias("n")))
    return _sets(base, ["status"]).agg(F.sum("n").alias("call_count"), _scope().alias("scope")).withColumn("pk", rollup_key())


def metric_totals(calls: DataFrame, marks_long: DataFrame) -> DataFrame:
    """Sum and count per day, scope and criterion, long.  A sum of zero is NULL, its count stays."""
    keyed = calls.select("call_id", timing.date_key("started_at").alias("date_key"), "team", "agent_key")
    base = (marks_long.join(keyed, "call_id").groupBy(*GRAIN, "criterion")
            .agg(F.sum("awarded").alias("s"), F.count("awarded").alias("n")))
    rolled = _sets(base, ["criterion"]).agg(F.sum("s").alias("metric_sum"), F.sum("n").alias("metric_count"),
                                            _scope().alias("scope"))
    return rolled.where(F.col("metric_count") > 0).withColumns({
        "metric_sum": F.nullif(F.round(F.col("metric_sum").cast("double"), 4), F.lit(0.0)), "pk": rollup_key()})


def as_map(long_rows: DataFrame, keys: list[str], name: str, value: str, out: str) -> DataFrame:
    """Nest a long table's (name, value) pairs per key; names come from a fixed vocabulary."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(name), F.col(value))))
    return long_rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.map_from_entries(pairs).alias(out))


def section_sums(metrics: DataFrame, keys: list[str], value: str = "awarded", out: str = "section_marks") -> DataFrame:
    """Sum of the marked criteria of each section; a section without marks has no row."""
    return (metrics.withColumn("section", marks.section_of("criterion"))
            .where(F.col("section").isNotNull() & F.col(value).isNotNull())
            .groupBy(*keys, "section").agg(F.sum(value).alias(out)))


def in_days(rows: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of an inclusive range of days, open at an end that isn't given. Ends may be timestamps in text; rows without a day are in no
    range that has an end. On a table stored by ``date_key`` only the days of the range are read."""
    if start:
        rows = rows.where(F.col("date_key") >= start[:10])
    if end:
        rows = rows.where(F.col("date_key") <= end[:10])
    return rows


def span(rollups: DataFrame, start: str | None = None, end: str | None = None, scope: str | None = None, pk: str | None = None) -> DataFrame:
    """One row per key over a range of days, open or closed: sums added, then divided once."""
    rows = in_days(rollups, start, end)
    if scope is not None:
        rows = rows.where(F.col("scope") == scope)
    if pk is not None:
        rows = rows.where(F.col("pk") == pk)
    added = rows.groupBy("pk").agg(*[F.sum(c).alias(c) for c in SUMS], F.max("score_max").alias("score_max"),
                                   F.min("score_min").alias("score_min"), F.count("*").alias("days"))
    # the mean is that of the settled sum: the raw one depends on the order of the days
    settled = added.withColumn("score_sum", F.round("score_sum", 4))
    return settled.withColumn("score_mean", F.round(F.try_divide("score_sum", "scored_calls"), 4))


def metric_span(metrics: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Mean mark per key and criterion over a range of days."""
    return _criterion_sums(metrics, start, end).withColumn("metric_mean", F.round(F.try_divide("metric_sum", "metric_count"), 4))


def section_span(metrics: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Per key and section over a range of days: the sum of its criteria, and the sum of their means."""
    means = _criterion_sums(metrics, start, end).withColumns({
        "section": marks.section_of("criterion"), "mean": F.try_divide("metric_sum", "metric_count")})
    added = means.where("section is not null").groupBy("pk", "section").agg(
        F.sum("metric_sum").alias("section_sum"), F.sum("mean").alias("section_mean"), F.count("mean").alias("criteria"))
    return added.withColumns({c: F.round(c, 4) for c in ("section_sum", "section_mean")})


def _criterion_sums(metrics: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return in_days(metrics, start, end).groupBy("pk", "criterion").agg(
        F.sum(F.coalesce("metric_sum", F.lit(0.0))).alias("metric_sum"), F.sum("metric_count").alias("metric_count"))


def leaderboard(spans: DataFrame, by: str = "score_mean", step: float = 0.01) -> DataFrame:
    """Rank the keys of a span, best first; keys without a value are left out.

    The ranking reads its rows three times, so the span is settled first.
    """
    return rank_descending(cut(spans.where(F.col(by).isNotNull())), by, F.floor(F.col(by) / step))


def rows_of(rollups: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored rows by key and day; stored by ``date_key``, only the wanted days are read."""
    return rollups.join(wanted.select("pk", "date_key").distinct(), ["pk", "date_key"], "left_semi")


def rebuild_days(calls_keyed: DataFrame, days: DataFrame) -> DataFrame:
    """Fresh roll-up rows of the touched days only, in one job."""
    touched = days.select("date_key").where(F.col("date_key") != "").distinct()
    wanted = calls_keyed.withColumn("date_key", timing.date_key("started_at")).join(touched, "date_key", "left_semi")
    return day_rollup(agent_days(wanted))

