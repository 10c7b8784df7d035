"""Dates and times (D-01 to D-08); stamps look like 20260811T102809Z."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLACK_S = 3600


def stamp_of(d: Column) -> Column:
    """The stamp in the last part of a directory; empty without one."""
    return F.regexp_extract(d, r"(\d{8}T\d{6}Z)[^/]*/*$", 1)


def iso_of_stamp(stamp: Column) -> Column:
    """D-01: the ISO form; empty for anything else."""
    rx = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})"
    return F.when(stamp.rlike(rx), F.regexp_replace(F.regexp_extract(stamp, rx, 0), rx, "$1-$2-$3T$4:$5:$6Z")).otherwise("")


def human_date(stamp: Column) -> Column:
    """D-01: 11 Aug 2026; anything else passes through."""
    date = F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd")
    return F.when(stamp.rlike(r"^\d{8}T") & date.isNotNull(), F.date_format(date, "d MMM yyyy")).otherwise(stamp)


def day_of(ts: Column) -> Column:
    """The calendar date of a text's first ten characters; null if unreadable."""
    return F.try_to_date(F.substring(ts, 1, 10), "yyyy-MM-dd")


def epoch_of_stamp(stamp: Column, fmt: str) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(stamp, F.lit(fmt)))


def is_fresh(snapshot_stamp: Column, asked: Column) -> Column:
    """D-03: the snapshot is no older than the slack when asked for; null if either is unreadable."""
    return (epoch_of_stamp(asked, "yyyy-MM-dd'T'HH:mm:ss'Z'") - epoch_of_stamp(snapshot_stamp, "yyyyMMddHHmmss")) <= SLACK_S


def witnesses(snapshot_stamp: Column, fetched: Column) -> Column:
    """D-04: the snapshot is within the slack of the fetch, on either side; null if either is unreadable."""
    return F.abs(epoch_of_stamp(snapshot_stamp, "yyyyMMddHHmmss") - epoch_of_stamp(fetched, "yyyy-MM-dd'T'HH:mm:ss'Z'")) <= SLACK_S


def age_hours(stamp: Column, now: Column) -> Column:
    """D-05: hours since the stamp; infinite if it is unreadable."""
    return F.coalesce((F.unix_timestamp(now) - epoch_of_stamp(stamp, "yyyyMMdd'T'HHmmss'Z'")) / 3600, F.lit(float("inf")))


def clamped(raw: Column, default: float, low: float, high: float) -> Column:
    """D-08: a number from a setting, the default where it is none, within bounds."""
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.coalesce(F.trim(raw).try_cast("double"), F.lit(float(default)))))
