"""Dates of forms, and the stamps of first sight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds by which a stamp of first sight may be off.
LIVE_PRECISION, BACKFILL_PRECISION, UNKNOWN_PRECISION = 300, 86_400, 315_360_000
LOOK_BACK_DAYS, LATE_AFTER_DAYS, SILENT_AFTER_HOURS = 14, 45, 24


def form_date(x: Column | str) -> Column:
    """A month/day/year date, padded or not; null if it is none."""
    return F.try_to_timestamp(x, F.lit("M/d/yyyy")).cast("date")


def unread_date(*texts: Column | str) -> Column:
    """The first of several texts that is neither blank nor a date; null if there is none."""
    return F.coalesce(*(F.when((F.trim(x) != "") & form_date(F.trim(x)).isNull(), F.trim(x)) for x in texts))


def strict_form_date(x: Column | str) -> Column:
    """As ``form_date`` for a blank, but a text that is no date stops the job."""
    return F.to_date(F.nullif(F.trim(x), F.lit("")), "M/d/yyyy")


def iso_date(x: Column | str) -> Column:
    """A year-month-day date; null if it is none, or blank."""
    return F.try_to_timestamp(F.nullif(F.trim(x), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def first_seen(filed: Column, now: Column, live: Column) -> Column:
    """struct(first_seen_at, precision_s): now for a live sight, else the start of the filing day, else now with no precision."""
    at = F.when(live | filed.isNull(), now).otherwise(filed.cast("timestamp"))
    precision = F.when(live, LIVE_PRECISION).when(filed.isNull(), UNKNOWN_PRECISION).otherwise(BACKFILL_PRECISION)
    return F.struct(at.alias("first_seen_at"), precision.alias("precision_s"))


def silent(last: Column, now: Column, hours: int = SILENT_AFTER_HOURS) -> Column:
    """Whether more than ``hours`` have passed; true if nothing ever came."""
    return F.coalesce(now.cast("timestamp").cast("long") - last.cast("timestamp").cast("long") > hours * 3600, F.lit(True))


def look_back_start(day: Column) -> Column:
    """The first filing day that a poll on ``day`` asks for: polls overlap, so that one that failed loses nothing."""
    return F.date_sub(day, LOOK_BACK_DAYS)


def backup_key(day: Column) -> Column:
    return F.concat(F.lit("backup_"), F.date_format(day, "yyyyMMdd"), F.lit(".json.gz"))
