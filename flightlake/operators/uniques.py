"""Distinct aircraft that add up: bitmaps per date beside gold, merged over any span of dates.

Daily distinct counts can't be added over dates or airports. Bitmaps over numbered aircraft can be
merged, exactly, without going back to the flights.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.operators.measures import slice_rows
from flightlake.operators.traffic import all_known, movements

# Aircraft are numbered within so many groups by hash, so that no task numbers them all.
NUMBER_GROUPS = 1024


def number_aircraft(flights: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(icao24, aircraft_id): every aircraft of the flights, numbered without gaps from 1.

    Numbers given before (`known`) stay; new aircraft go on after the highest one. Within a group
    aircraft are numbered by name, and groups one after the other, so a retried task gives the
    same numbers.
    """
    aircraft = flights.where(F.col("icao24").isNotNull()).select("icao24").distinct()
    last: Column = F.lit(0).cast("long")
    if known is not None:
        aircraft = aircraft.join(known, "icao24", "left_anti")
        highest = known.agg(F.coalesce(F.max("aircraft_id"), F.lit(0)).alias("last"))
        last = highest.scalar()
    grouped = aircraft.withColumn("part", F.pmod(F.xxhash64("icao24"), F.lit(NUMBER_GROUPS)))
    # The join asks for this; asked for here, starts and places are made of one and the same shuffle.
    grouped = grouped.where(F.col("part").isNotNull())
    # A row per group, NUMBER_GROUPS at most.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = grouped.groupBy("part").agg(F.count("*").alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("icao24"))
    numbered = grouped.withColumn("place", place).join(F.broadcast(starts), "part")
    new = numbered.select(
        "icao24", (last + F.col("start") + F.col("place")).cast("long").alias("aircraft_id")
    )
    return new if known is None else known.unionByName(new)


def daily_bitmaps(enriched: DataFrame, numbers: DataFrame, dimension: str) -> DataFrame:
    """Per date and airport or country the aircraft seen at either end, as bitmaps.

    Flights are folded to one row per date, group and aircraft before they get numbers, so a busy
    airport or aircraft is small by then. A bucket holds 32,768 numbers. The numbers of a bucket
    meet before its bitmap is made: a bitmap has its full size from the first number on, so one
    per task and bucket would outgrow the flights.
    """
    keys = ["flight_date", dimension]
    seen = movements(enriched).where(all_known([*keys, "icao24"])).select(*keys, "icao24").distinct()
    placed = seen.join(numbers, "icao24").select(
        *keys,
        F.bitmap_bucket_number("aircraft_id").alias("bucket"),
        F.bitmap_bit_position("aircraft_id").alias("position"),
    )
    return (
        placed.repartition(*keys, "bucket")
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
    )


def aircraft_of(bitmaps: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Distinct aircraft per group of dates, airports or countries, from bitmaps only. A group in
    which no known aircraft was seen has no row."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = [c for c in merged.columns if c not in ("bucket", "bits")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias("aircraft"))


def aircraft_between(
    bitmaps: DataFrame, dimension: str, first: str | dt.date, last: str | dt.date
) -> DataFrame:
    """Distinct aircraft per airport or country over a span of dates, both ends included."""
    return aircraft_of(slice_rows(bitmaps, first, last), [dimension])


def aircraft_by_month(bitmaps: DataFrame, dimension: str) -> DataFrame:
    """Distinct aircraft per calendar month and airport or country."""
    month = F.trunc("flight_date", "month").alias("month")
    return aircraft_of(bitmaps, [month, dimension])
