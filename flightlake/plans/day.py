"""The daily run: bronze batches of one date to silver, enriched and gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlake.functions import times
from flightlake.operators import enrich, history, silver, traffic
from flightlake.plans import windows
from flightlake.schemas import (
    AIRPORT_TRAFFIC,
    COUNTRY_TRAFFIC,
    ENRICHED_SCHEMA,
    GOLD_TABLES,
    ROUTE_TRAFFIC,
    SILVER_SCHEMA,
)
from flightlake.session import parse_day, prepare
from flightlake.sources import airports, bronze, payload, tables


@dataclass(frozen=True)
class Lake:
    """Folders of one lake, on storage every executor can reach."""

    root: str
    airports_csv: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/flights"

    @property
    def enriched(self) -> str:
        return f"{self.root}/silver/flights_enriched"

    def gold(self, table) -> str:
        return f"{self.root}/gold/{table.name}"

    def warehouse(self, table) -> str:
        return f"{self.root}/warehouse/{table.name}"


def land_windows(
    spark: SparkSession, lake: Lake, payload_dir: str, day: str | dt.date, names: list[str]
) -> None:
    """Bronze batches of the named windows of a day, from payload files in one job.

    A window's files are named like its batch, with `.json` (an array of objects) or `.jsonl`
    (an object per line) for `.csv`, and anything between. Each window must have a payload,
    which is checked before anything is written; one without flights has a file that holds
    `[]`. A broken file is an error and leaves bronze as it was.
    """
    files = payload.payload_files(prepare(spark), payload_dir, day)
    payload.require_windows(files, names)
    raw = payload.read_payload(spark, [p for name in names for p in files[name]])
    bronze.write_landed(payload.project_payload(raw), lake.bronze, day, names)


def land_day(spark: SparkSession, lake: Lake, payload_dir: str, day: str | dt.date) -> DataFrame:
    """Backfill a whole day's bronze. Returns rows per window."""
    names = [times.window_label_of(*window) for window in windows.day_windows(day)]
    land_windows(spark, lake, payload_dir, day, names)
    return landed_windows(spark, lake, day)


def landed_windows(spark: SparkSession, lake: Lake, day: str | dt.date) -> DataFrame:
    """The day's planned windows with the rows that arrived in each, zero included."""
    planned = spark.createDataFrame([(parse_day(day),)], "day date")
    counts = bronze.batch_counts(bronze.read_bronze(spark, lake.bronze, day))
    return windows.plan_coverage(windows.backfill_plan(planned, "day"), counts)


def silver_day(
    spark: SparkSession, lake: Lake, day: str | dt.date, na_tokens: Iterable[str] = ()
) -> dict[str, int]:
    """Clean all batches of the date; without any the scan fails. Returns the run's counts, those
    of `silver.silver_quality`, which are taken as the rows are written."""
    counted = silver.SilverCounts()
    batches = bronze.read_bronze(prepare(spark), lake.bronze, day, na_tokens)
    flights = silver.build_silver(counted.observed_bronze(batches))
    tables.write_day(counted.observed_silver(flights), lake.silver, day)
    return counted.counts()


def enrich_day(
    spark: SparkSession, lake: Lake, day: str | dt.date, na_tokens: Iterable[str] = ()
) -> dict[str, int]:
    """Add airports at both ends. Returns how many flights matched, counted on the way."""
    flights = tables.read_day(prepare(spark), lake.silver, SILVER_SCHEMA, day)
    reference = airports.read_airports(spark, lake.airports_csv, na_tokens)
    lookup = enrich.build_lookup(reference)
    small = enrich.is_broadcastable(lookup)
    matched = Observation()
    enriched = enrich.enrich_flights(flights, lookup, small).observe(
        matched,
        F.count(F.lit(1)).alias("flights"),
        F.count("departure_airport_name").alias("departures_matched"),
        F.count("arrival_airport_name").alias("arrivals_matched"),
    )
    tables.write_day(enriched, lake.enriched, day)
    return dict(matched.get)


def enriched_flights_of(spark: SparkSession, lake: Lake, day: str | dt.date) -> DataFrame:
    """Flights ingested for the date and departing on it. Flights delivered with this date
    but departing on another stay out, so a rerun never overwrites another day's gold."""
    enriched = tables.read_day(prepare(spark), lake.enriched, ENRICHED_SCHEMA, day)
    return traffic.filter_date(enriched, day)


def gold_day(spark: SparkSession, lake: Lake, day: str | dt.date) -> None:
    """The three gold tables of a date, each replaced as a whole, by nothing if need be.
    Airports and countries count the same activity of aircraft at airports."""
    flights = enriched_flights_of(spark, lake, day)
    if flights.isEmpty():
        raise ValueError(f"no flights depart on {parse_day(day)}")
    builders = {
        AIRPORT_TRAFFIC: traffic.airport_traffic,
        COUNTRY_TRAFFIC: traffic.country_traffic,
        ROUTE_TRAFFIC: traffic.route_traffic,
    }
    for table, build in builders.items():
        history.write_gold_day(build(flights), lake.gold(table), day, table)


def run_day(
    spark: SparkSession, lake: Lake, day: str | dt.date, na_tokens: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """The whole day. Every step reads the table the step before wrote, so a failed run
    resumes from stored data, and running a date again gives the same tables."""
    day = parse_day(day)
    silver_day(spark, lake, day, na_tokens)
    enrich_day(spark, lake, day, na_tokens)
    gold_day(spark, lake, day)
    return {t.name: history.read_gold(spark, lake.gold(t), t) for t in GOLD_TABLES}


def day_report(spark: SparkSession, lake: Lake, day: str | dt.date) -> DataFrame:
    """One row of counts about a finished run. Taken from the stored tables, where retries
    leave no trace, rather than from counters updated while tasks run."""
    batches = bronze.read_bronze(prepare(spark), lake.bronze, day)
    enriched = tables.read_day(spark, lake.enriched, ENRICHED_SCHEMA, day)

    def rows(table: DataFrame) -> Column:
        return table.agg(F.count("*")).scalar()

    counts = enriched.agg(
        F.count("*").alias("silver_rows"),
        F.count("departure_airport").alias("rows_with_departure"),
        F.count("arrival_airport").alias("rows_with_arrival"),
        F.count("route").alias("rows_with_route"),
        F.count("departure_airport_name").alias("departures_matched"),
        F.count("arrival_airport_name").alias("arrivals_matched"),
        F.count_if(F.col("flight_date") == F.lit(parse_day(day))).alias("rows_on_date"),
    )
    return counts.select(
        rows(batches).alias("bronze_rows"),
        (F.col("bronze_rows") - F.col("silver_rows")).alias("duplicates_removed"),
        "*",
        *[
            rows(history.read_gold_day(spark, lake.gold(t), day, t)).alias(f"{t.name}_rows")
            for t in GOLD_TABLES
        ],
    )


def load_warehouse(spark: SparkSession, lake: Lake, day: str | dt.date | None = None) -> None:
    """Upsert gold into the target tables, one table after the other; the whole history, or
    one date of it."""
    prepare(spark)
    for table in GOLD_TABLES:
        path = lake.gold(table)
        if day is None:
            batch = history.read_gold(spark, path, table)
        else:
            batch = history.read_gold_day(spark, path, day, table)
        history.upsert_gold(spark, batch, lake.warehouse(table), table)
