"""Call-log rows into call rows: sides of the call, stored shape, keys, status changes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import marks, paths, text, timing


def _inbound() -> Column:
    return F.upper("call_direction") == "INBOUND"


def recording_url(raw: Column | str) -> Column:
    """The recording's address; a placeholder or another scheme is no recording."""
    value = F.col(raw) if isinstance(raw, str) else raw
    low = F.lower(value)
    real = ~low.isin(list(K.NO_VALUE_WORDS)) & low.rlike("^https?://")
    return F.when(real, value).otherwise(F.lit(""))


def with_sides(log: DataFrame) -> DataFrame:
    """Which side is the agent depends on the direction; the other side is the customer."""
    pick = lambda if_in, if_out: F.when(_inbound(), F.col(if_in)).otherwise(F.col(if_out))
    primary = text.ten_digits(pick("did", "outbound_caller_id"))
    secondary = text.ten_digits(pick("outbound_caller_id", "did"))
    sides = log.withColumns({
        "agent_extension": pick("callee", "caller"),
        "agent_display_name": pick("callee_name", "caller_name"),
        "customer_phone": text.ten_digits(pick("caller", "callee")),
        "agent_did": F.coalesce(text.blank_to_null(primary), secondary),
        "recording_url": recording_url("call_rec_path"),
        "started_at": timing.local_to_utc("start_date"),
    })
    return sides.withColumn("is_auditable", is_auditable())


def is_auditable() -> Column:
    return (F.lower("call_status") == "answered") & (F.col("recording_url") != "") & (F.col("call_sec") > 0)


def to_call_rows(resolved: DataFrame, status: str, now: Column) -> DataFrame:
    """Stored call rows from sided log rows that carry their resolved agent.

    The log's own extension wins.  The roster's name is used for a known agent only; otherwise the
    log's display name, and the placeholder last.
    """
    own_name = F.coalesce(text.blank_to_null("agent_display_name"), F.col("roster_name"))
    return resolved.select(
        F.col("callid").alias("call_id"), "customer_phone", "started_at",
        F.col("call_sec").alias("duration_sec"),
        F.coalesce(text.blank_to_null("agent_extension"), F.col("roster_extension")).alias("agent_extension"),
        F.when(F.col("known"), F.col("roster_name")).otherwise(own_name).alias("agent_name"),
        F.lit(status).alias("processing_status"), F.col("call_direction"), now.alias("status_at"))


def sparse(calls: DataFrame, columns: tuple[str, ...] = K.STORED_ATTRIBUTES) -> DataFrame:
    """Stored attributes only; an empty text is absent, that is NULL."""
    kinds = dict(calls.dtypes)
    kept = [text.blank_to_null(c).alias(c) if kinds[c] == "string" else F.col(c) for c in columns if c in kinds]
    return calls.select("call_id", *kept)


def work_status(status: Column | str = "processing_status") -> Column:
    value = F.col(status) if isinstance(status, str) else status
    return F.when(value.isin(list(K.WORK_STATUSES)), value)


def with_keys(calls: DataFrame) -> DataFrame:
    """The access keys as columns: outstanding work, agent-month, day, and the shared order."""
    return calls.withColumns({
        "work_status": work_status(),
        "agent_month_key": F.concat_ws("#", F.lit("AGENT"), "agent_extension", timing.month_key("started_at")),
        "day_key": F.concat(F.lit("DAY#"), timing.date_key("started_at")),
        "time_ordinal": F.concat_ws("#", timing.iso_utc("started_at"), "call_id"),
        "pk": F.concat(F.lit("CALL#"), F.col("call_id")),
    })


def hydrate(items: DataFrame) -> DataFrame:
    """Read a stored item back: what the keys and pure functions can produce is recomputed."""
    started = F.substring_index("time_ordinal", "#", 1)
    moment = timing.parse_iso(started)
    call_id = F.regexp_extract("pk", r"^CALL#(.*)$", 1)
    status = F.col("processing_status")
    return items.withColumns({
        "call_id": call_id,
        "started_at_iso": started,
        "agent_extension": F.regexp_extract("agent_month_key", r"^AGENT#(.*)#[^#]*$", 1),
        "date_key": timing.date_key(moment),
        "audio_key": F.when(status == "DISCARDED", "").otherwise(paths.audio_key(call_id, moment)),
        "audit_key": F.when(status == "PROCESSED", paths.artifact_key(call_id, moment, "audit")).otherwise(""),
        "score_band": F.when(F.col("score").isNotNull() | (status == "PROCESSED"), marks.score_band("score")),
    })


def dashboard_fields(documents: DataFrame, document: str = "doc") -> DataFrame:
    """The scalars a call row carries, projected off a parsed audit document."""
    scores = f"{document}.scores"
    flags = F.coalesce(F.col(f"{document}.report.compliance_flags"), F.array())
    void = F.coalesce(F.col(f"{scores}.disqualified"), F.lit(False))
    return documents.select(
        "call_id",
        F.when(~void, F.col(f"{scores}.overall_score_100")).alias("score"),
        F.coalesce(F.col(f"{scores}.flag_count"), F.size(flags).cast("bigint")).alias("flag_count"),
        worst_severity(F.transform(flags, lambda f: f["severity"])).alias("audit_status"),
        void.alias("disqualified"),
        F.when(F.size(f"{scores}.criterion_marks") > 0, F.col(f"{scores}.criterion_marks")).alias("criterion_marks"))


def worst_severity(severities: Column) -> Column:
    """The highest known severity of an array, upper case; NULL when there is none."""
    ranks = F.filter(F.transform(severities, marks.severity_rank), lambda r: r.isNotNull())
    return F.upper(marks.severity_name(F.array_max(ranks)))


def discard(calls: DataFrame, condition: Column, cleared: tuple[str, ...] = K.TOMBSTONE_CLEARED) -> DataFrame:
    """Reduce the rows that meet ``condition`` to tombstones."""
    changed = {c: F.when(~condition, F.col(c)) for c in cleared if c in calls.columns}
    flagged = calls.withColumn("_gone", condition)
    changed = {c: F.when(~F.col("_gone"), F.col(c)) for c in changed}
    changed["processing_status"] = F.when(F.col("_gone"), "DISCARDED").otherwise(F.col("processing_status"))
    return flagged.withColumns(changed).drop("_gone")


def fail_stalled(calls: DataFrame, now: Column, minutes: int = K.STUCK_AFTER_MINUTES,
                 reason: str = "the download never finished") -> DataFrame:
    """Rows left INGESTING since before the cutoff become FAILED; ``stalled`` marks them."""
    cutoff = now - F.expr(f"INTERVAL {minutes} MINUTES")
    since = F.coalesce("status_at", "started_at")
    stalled = ((F.col("processing_status") == "INGESTING") & (F.col("started_at") <= cutoff)
               & ~F.coalesce(since > cutoff, F.lit(False)))
    return (calls.withColumn("stalled", F.coalesce(stalled, F.lit(False))).withColumns({
        "processing_status": F.when(F.col("stalled"), "FAILED").otherwise(F.col("processing_status")),
        "failure_reason": F.when(F.col("stalled"), reason).otherwise(F.col("failure_reason")),
        "status_at": F.when(F.col("stalled"), now).otherwise(F.col("status_at"))}))


def revive_legacy(calls: DataFrame, now: Column) -> DataFrame:
    """Rows of the retired status AUDITING go back to UNPROCESSED."""
    old = F.col("processing_status") == "AUDITING"
    return calls.withColumn("revived", old).withColumns({
        "processing_status": F.when(F.col("revived"), "UNPROCESSED").otherwise(F.col("processing_status")),
        "status_at": F.when(F.col("revived"), now).otherwise(F.col("status_at"))})


def apply_status_changes(calls: DataFrame, changes: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """``changes(call_id, expected_status, new_status)`` against the stored rows, one after another.

    A change applies when its row exists and, where a status is expected, the row has it by then: of
    two claims of one call the second loses.  ``order`` are the columns that say which comes first;
    ties go by the statuses.  One row per change comes back, the losers with ``applied`` false.
    The changes of a call stream by in order, so none are gathered.
    """
    stored = calls.select("call_id", "processing_status")
    tried = changes.join(stored, "call_id", "left")
    by = [*order, "expected_status", "new_status"]
    # by a hash: a shuffle by the key itself is left out after the join, which may turn into a broadcast at run time
    ranked = tried.repartition(F.xxhash64("call_id")).sortWithinPartitions("call_id", *by)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call, status = None, None
        for rows in batches:
            done, after = [], []
            for one, stored_status, expected, new in zip(rows["call_id"], rows["processing_status"], rows["expected_status"], rows["new_status"], strict=True):
                if one != call:
                    call, status = one, None if pd.isna(stored_status) else stored_status
                wins = status is not None and (pd.isna(expected) or expected == status)
                status = new if wins else status
                done.append(wins)
                after.append(status)
            yield rows.assign(applied=done, status_after=after)

    kinds = ", ".join(f"`{n}` {k}" for n, k in tried.dtypes)
    settled = ranked.mapInPandas(settle, f"{kinds}, applied boolean, status_after string")
    return settled.withColumn("work_status", work_status("status_after"))


def audit_disposition(jobs: DataFrame, calls: DataFrame) -> DataFrame:
    """What an audit job leaves on its row.

    ``jobs(call_id, audio_present, error_kind, error)``: ``error_kind`` is ``stage`` for a pipeline
    stage, another text for anything else, NULL for success.  ``failure_reason`` is what the row holds
    afterwards: a skipped job leaves the stored one alone, an audit clears it.
    """
    before = F.col("failure_reason") if "failure_reason" in calls.columns else F.lit(None).cast("string")
    rows = calls.select("call_id", "processing_status", "started_at", before.alias("_reason"), paths.audio_key("call_id", "started_at").alias("audio_key"))
    joined = jobs.join(rows, "call_id", "left")
    status, kind = F.col("processing_status"), F.col("error_kind")
    staged = F.left(F.concat(F.lit("pipeline: "), "error"), F.lit(K.REASON_CHARS))
    other = F.left(F.concat("error_kind", F.lit(": "), "error"), F.lit(K.REASON_CHARS))
    missing = F.concat(F.lit("audio missing at "), "audio_key")
    outcome = (F.when(status.isNull(), "skipped").when(status.isin(list(K.TERMINAL_STATUSES)), "skipped")
               .when(F.col("audio_key").isNull(), "failed").when(~F.col("audio_present"), "failed")
               .when(kind == "stage", "retry").when(kind.isNotNull(), "failed").otherwise("audited"))
    detail = (F.when(status.isNull(), "no row")
              .when(status.isin(list(K.TERMINAL_STATUSES)), F.concat(F.lit("already "), status))
              .when(F.col("audio_key").isNull(), "no audioKey").when(~F.col("audio_present"), missing)
              .when(kind == "stage", staged).when(kind.isNotNull(), other)
              .otherwise(timing.date_key("started_at")))
    return joined.withColumns({"outcome": outcome, "detail": detail}).withColumns({
        "status_after": F.when(F.col("outcome") == "audited", "PROCESSED").when(F.col("outcome") == "retry", "UNPROCESSED")
        .when(F.col("outcome") == "failed", "FAILED").otherwise(status),
        "failure_reason": F.when(F.col("outcome") == "skipped", F.col("_reason")).when(F.col("detail") == "no audioKey", K.NO_AUDIO_KEY_REASON)
        .when(F.col("outcome").isin("retry", "failed"), F.col("detail"))}).drop("_reason")


def is_review() -> Column:
    """At least one flag and a scorecard that still stands."""
    return (F.coalesce("flag_count", F.lit(0)) > 0) & ~F.coalesce("disqualified", F.lit(False))


def point_lookup(calls: DataFrame, keys: DataFrame, key: str = "call_id") -> DataFrame:
    """The stored rows of many keys at once."""
    return calls.join(keys.select(key), key, "left_semi")


def existing(calls: DataFrame, keys: DataFrame, key: str = "call_id") -> DataFrame:
    """``keys`` with ``is_stored``: whether there is a row of that key."""
    stored = calls.select(key).distinct().withColumn("is_stored", F.lit(True))
    return keys.join(stored, key, "left").withColumn("is_stored", F.coalesce("is_stored", F.lit(False)))


def by_token(log: DataFrame, wanted: DataFrame, minutes: int = K.TOKEN_WINDOW_MINUTES, token: str = "unique_token",
             at: str = "start_ts") -> DataFrame:
    """The log row of each ``wanted(token, around)`` that starts within the minutes around; ``deliveries`` of it.

    Of several the first counts, by start and then call id.  A wanted token without a row has NULL fields and no deliveries.
    """
    pad = F.expr(f"INTERVAL {minutes} MINUTES")
    asked = wanted.select(token, "around").distinct()
    near = asked.join(log.select(token, at, "callid"), token).where(F.col(at).between(F.col("around") - pad, F.col("around") + pad))
    first = near.groupBy(token, "around").agg(F.min(F.struct(at, "callid")).alias("_row"), F.count("*").alias("deliveries"))
    return (asked.join(first, [token, "around"], "left")
            .select(token, "around", "_row.callid", F.col(f"_row.{at}").alias(at), F.coalesce("deliveries", F.lit(0)).cast("bigint").alias("deliveries")))


def list_calls(calls: DataFrame, agent: str | None = None, status: str | None = None,
               start: Column | None = None, end: Column | None = None, limit: int | None = None) -> DataFrame:
    """Newest first, filtered; without a window there is no time filter."""
    found = calls
    if agent is not None:
        found = found.where(F.col("agent_extension") == agent)
    if status is not None:
        found = found.where(F.col("processing_status") == status)
    if start is not None:
        found = found.where(F.col("started_at") >= start)
    if end is not None:
        found = found.where(F.col("started_at") <= end)
    found = found.orderBy(F.desc("started_at"), "call_id")
    return found.limit(limit) if limit else found


def pending(calls: DataFrame, limit: int | None = None) -> DataFrame:
    """Unprocessed calls, oldest first."""
    found = calls.where(F.col("processing_status") == "UNPROCESSED").orderBy("started_at", "call_id")
    return found.limit(limit) if limit else found


def outstanding_counts(calls: DataFrame) -> DataFrame:
    """Calls per outstanding status; a status without calls has no row."""
    return (calls.where(work_status().isNotNull()).groupBy("processing_status")
            .agg(F.count("*").alias("call_count")))
