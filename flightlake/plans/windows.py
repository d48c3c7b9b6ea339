"""Ingestion windows: the last hour, a day, and the two-hour batches of a backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions import times
from flightlake.session import parse_day


def last_hour(df: DataFrame, now: str) -> DataFrame:
    """Adds the window an hourly ingestion started at `now` covers."""
    start, end = times.last_hour_window(F.col(now))
    return df.withColumns({"window_start": start, "window_end": end})


def previous_day(df: DataFrame, now: str) -> DataFrame:
    """Adds the whole UTC day before `now`."""
    start, end = times.day_window(times.previous_day(F.col(now)))
    return df.withColumns({"window_start": start, "window_end": end})


def whole_day(df: DataFrame, day: str) -> DataFrame:
    start, end = times.day_window(F.col(day))
    return df.withColumns({"window_start": start, "window_end": end})


def backfill_plan(days: DataFrame, day: str, hours: int = times.WINDOW_HOURS) -> DataFrame:
    """One row per window of every day in `days`, numbered from 1, with the batch name. The
    last window ends with the day even where `hours` does not divide it."""
    starts = times.ingest_window_starts(F.col(day), hours)
    plan = days.select("*", F.posexplode(starts).alias("_position", "window_start"))
    plan = plan.withColumn("window_end", times.ingest_window_end(F.col("window_start"), hours))
    return plan.select(
        *days.columns,
        (F.col("_position") + 1).alias("window_number"),
        "window_start",
        "window_end",
        times.window_label(F.col("window_start"), F.col("window_end")).alias("bronze_file"),
    )


def window_counts(df: DataFrame, ts: str, hours: int = times.WINDOW_HOURS) -> DataFrame:
    """Rows per ingestion window, with the window's ingestion date and bronze batch name.
    Rows are counted by the window's start; only the counts get a name."""
    started = df.select(times.ingest_window_start(F.col(ts), hours).alias("window_start"))
    counts = started.groupBy("window_start").agg(F.count("*").alias("row_count"))
    ended = counts.withColumn("window_end", times.ingest_window_end(F.col("window_start"), hours))
    return ended.select(
        F.to_date("window_start").alias("ingest_date"),
        "window_start",
        "window_end",
        times.window_label(F.col("window_start"), F.col("window_end")).alias("bronze_file"),
        "row_count",
    )


def plan_coverage(plan: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows received per planned window; a window without any counts zero."""
    return plan.join(counts, "bronze_file", "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0)).cast("long")
    )


def hourly_window(now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """The last completed hour for a job argument, timezone-aware input expected."""
    end = now.astimezone(dt.timezone.utc).replace(minute=0, second=0, microsecond=0)
    return end - dt.timedelta(hours=1), end


def day_windows(
    day: str | dt.date, hours: int = times.WINDOW_HOURS
) -> list[tuple[dt.datetime, dt.datetime]]:
    """The windows of `backfill_plan` for one day, for a job that lands them one by one."""
    midnight = dt.datetime.combine(parse_day(day), dt.time())
    cuts = [midnight + dt.timedelta(hours=h) for h in range(0, 24, hours)]
    return list(zip(cuts, cuts[1:] + [midnight + dt.timedelta(days=1)]))
