"""Time expressions. Tables carry wall-clock UTC (TIMESTAMP_NTZ), streams carry instants."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def wall(moment: datetime | str | Column) -> Column:
    """A moment given by the caller as a TIMESTAMP_NTZ constant (folds, so it can be pushed down)."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def day(value: date | str | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for either timestamp type."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def hour_of_day(ts: Column, tz: str = "UTC") -> Column:
    local = ts if tz == "UTC" else F.from_utc_timestamp(ts.cast("timestamp"), tz)
    return F.hour(local)


def is_weekend(ts: Column, tz: str = "UTC") -> Column:
    """Saturday or Sunday; Spark's weekday() counts from Monday = 0."""
    local = ts if tz == "UTC" else F.from_utc_timestamp(ts.cast("timestamp"), tz)
    return F.weekday(local) >= 5
