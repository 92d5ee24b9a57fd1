"""Time expressions: tenant clock, UTC instants, business days and path parts."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def local_to_utc(text: Column | str, zone: str = K.TENANT_ZONE) -> Column:
    """The log's naive local time as a UTC timestamp; NULL when it cannot be read."""
    return F.to_utc_timestamp(F.try_to_timestamp(_col(text), F.lit(K.LOG_TIME_FORMAT)), zone)


def iso_utc(moment: Column | str) -> Column:
    return F.date_format(_col(moment), K.ISO_UTC_FORMAT)


def local_to_iso(text: Column | str, zone: str = K.TENANT_ZONE) -> Column:
    return F.coalesce(iso_utc(local_to_utc(text, zone)), F.lit(""))


def utc_to_local(moment: Column | str, zone: str = K.TENANT_ZONE) -> Column:
    return F.from_utc_timestamp(_col(moment), zone)


def parse_iso(text: Column | str) -> Column:
    """A timestamp with ``Z``, an offset or neither; NULL when it cannot be read."""
    return F.try_to_timestamp(_col(text))


def date_key(moment: Column | str) -> Column:
    return F.date_format(_col(moment), "yyyy-MM-dd")


def date_path(moment: Column | str) -> Column:
    return F.date_format(_col(moment), "yyyy/MM/dd")


def month_key(moment: Column | str) -> Column:
    return F.date_format(_col(moment), "yyyy-MM")


def business_day(moment: Column | str, hour: int = K.DAY_START_HOUR, zone: str = K.TENANT_ZONE) -> Column:
    """The tenant day, opening at ``hour``, that a UTC instant falls on."""
    return F.date_format(utc_to_local(moment, zone) - F.expr(f"INTERVAL {hour} HOURS"), "yyyy-MM-dd")


def last_complete_day(now: Column | str, hour: int = K.DAY_START_HOUR,
                      grace_minutes: int = K.DAY_GRACE_MINUTES, zone: str = K.TENANT_ZONE) -> tuple[Column, Column]:
    """UTC bounds of the newest complete tenant day; one that closes within the grace counts."""
    local = utc_to_local(now, zone)
    today = F.date_trunc("day", local) + F.expr(f"INTERVAL {hour} HOURS")
    late = today > local + F.expr(f"INTERVAL {grace_minutes} MINUTES")
    end = F.when(late, today - F.expr("INTERVAL 1 DAY")).otherwise(today)
    return (F.to_utc_timestamp(end - F.expr("INTERVAL 1 DAY"), zone), F.to_utc_timestamp(end, zone))


class Period(NamedTuple):
    """What a run fetches, in UTC.  An empty one ends where it starts, or before."""

    start: dt.datetime
    end: dt.datetime
    kind: str

    @property
    def is_empty(self) -> bool:
        return self.end <= self.start


def _utc(moment: dt.datetime) -> dt.datetime:
    return moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)


def explicit_window(start: str | None, end: str | None, now: dt.datetime, hour: int = K.DAY_START_HOUR,
                    grace_minutes: int = K.DAY_GRACE_MINUTES, zone: str = K.TENANT_ZONE) -> Period:
    """The period of a run: the one named, or else the newest complete tenant day.

    An end without a start is an error; a start alone runs until ``now``.  Times without a zone are UTC.
    """
    if start:
        last = _utc(dt.datetime.fromisoformat(end.replace("Z", "+00:00"))) if end else _utc(now)
        return Period(_utc(dt.datetime.fromisoformat(start.replace("Z", "+00:00"))), last, "explicit")
    if end:
        raise ValueError("a window end needs a window start")
    local = _utc(now).astimezone(ZoneInfo(zone))
    closes = local.replace(hour=hour, minute=0, second=0, microsecond=0)
    if closes > local + dt.timedelta(minutes=grace_minutes):
        closes -= dt.timedelta(days=1)
    return Period(_utc(closes - dt.timedelta(days=1)), _utc(closes), "day")


def slices(windows: DataFrame, start: str = "window_start", end: str = "window_end",
           minutes: int = K.SLICE_MINUTES) -> DataFrame:
    """Each window cut into half-open slices, oldest first; the last may be short."""
    step = f"INTERVAL {minutes} MINUTES"
    starts = F.sequence(F.col(start), F.col(end) - F.expr("INTERVAL 1 MICROSECOND"), F.expr(step))
    return (windows.where(F.col(start) < F.col(end))
            .withColumn("slice_start", F.explode(starts))
            .withColumn("slice_end", F.least(F.col("slice_start") + F.expr(step), F.col(end))))


def day_text_bounds(day: Column | str) -> tuple[Column, Column]:
    """Text bounds that hold every timestamp of a day, whatever its offset suffix."""
    return F.concat(_col(day), F.lit("T")), F.concat(_col(day), F.lit("T23:59:59Z"))


def days_newest_first(start: Column | str, end: Column | str) -> Column:
    return F.sequence(F.to_date(_col(end)), F.to_date(_col(start)), F.expr("INTERVAL -1 DAY"))


def months_oldest_first(start: Column | str, end: Column | str) -> Column:
    months = F.sequence(F.trunc(F.to_date(_col(start)), "month"), F.to_date(_col(end)), F.expr("INTERVAL 1 MONTH"))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def run_id(spark: SparkSession) -> str:
    """``yyyyMMddTHHmmssZ-`` and eight hex digits, from the session's own clock and generator."""
    row = spark.range(1).select(
        F.concat(F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmss'Z-'"),
                 F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 8)).alias("id")).first()
    return row["id"]


def expiry_epoch(moment: Column | str, days: int = K.RUN_TTL_DAYS) -> Column:
    return F.unix_timestamp(_col(moment)) + F.lit(days * 86_400)
