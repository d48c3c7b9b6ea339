"""Epochs, dates and ingestion windows. All of it in UTC (see `session.REQUIRED`)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest whole second a 64-bit nanosecond clock can hold.
MAX_EPOCH_SECONDS = 9223372036

WINDOW_HOURS = 2


def epoch_to_timestamp(seconds: Column) -> Column:
    in_range = F.abs(seconds) <= F.lit(float(MAX_EPOCH_SECONDS))
    return F.timestamp_seconds(F.when(in_range, seconds))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end, null when negative."""
    minutes = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)
    return F.when(minutes >= 0, minutes)


def in_time_order(start: Column, end: Column) -> Column:
    """False only where both ends are known and the end comes first."""
    return F.coalesce(end >= start, F.lit(True))


def to_date_or_null(text: Column) -> Column:
    return text.try_cast("date")


def last_hour_window(now: Column) -> tuple[Column, Column]:
    """The last completed hour before `now`, as [start, end)."""
    end = F.date_trunc("hour", now)
    return end - F.expr("INTERVAL 1 HOUR"), end


def day_window(day: Column) -> tuple[Column, Column]:
    """Midnight to midnight, as [start, end)."""
    return day.cast("timestamp"), F.date_add(day, 1).cast("timestamp")


def previous_day(now: Column) -> Column:
    return F.date_sub(F.to_date(now), 1)


def ingest_window_start(ts: Column, hours: int = WINDOW_HOURS) -> Column:
    """Start of the ingestion window holding `ts`; windows are counted from midnight."""
    seconds = F.unix_timestamp(ts)
    into_window = F.pmod(F.pmod(seconds, F.lit(86400)), F.lit(hours * 3600))
    return F.timestamp_seconds(seconds - into_window)


def ingest_window_end(start: Column, hours: int = WINDOW_HOURS) -> Column:
    """End of the window: `hours` later, but never past the end of the day."""
    _, day_end = day_window(F.to_date(start))
    return F.least(start + F.expr(f"INTERVAL {int(hours)} HOURS"), day_end)


def ingest_window_starts(day: Column, hours: int = WINDOW_HOURS) -> Column:
    """Array of the window starts of one day."""
    start, end = day_window(day)
    return F.sequence(start, end - F.expr("INTERVAL 1 SECOND"), F.expr(f"INTERVAL {int(hours)} HOURS"))


def window_label(start: Column, end: Column) -> Column:
    """Name of the bronze batch of a window, dated by the window's start."""
    return F.concat(
        F.lit("flights_"),
        F.date_format(start, "yyyy-MM-dd_HH-mm"),
        F.lit("_to_"),
        F.date_format(end, "HH-mm"),
        F.lit(".csv"),
    )


def window_label_of(start: dt.datetime, end: dt.datetime) -> str:
    """The same name for a window known on the driver."""
    return f"flights_{start:%Y-%m-%d_%H-%M}_to_{end:%H-%M}.csv"
