"""Flights that come late, or again: deliveries go to the dates they belong to and count once.

A delivery is what one run takes in: an ingestion date, or a micro-batch of a stream. Its flights
are stored by flight date and delivery. Copies of a record have the same first sighting, hence the
same flight date, so the first of several deliveries is chosen within a date, without a search
through the history. The dates a delivery touches are the folders it wrote to; only these are
made anew, each from all of its deliveries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.operators import enrich, history, silver, traffic
from flightlake.plans.day import Lake
from flightlake.schemas import (
    AIRPORT_TRAFFIC,
    COUNTRY_TRAFFIC,
    ENRICHED_SCHEMA,
    GOLD_TABLES,
    ROUTE_TRAFFIC,
    SILVER_SCHEMA,
    GoldTable,
)
from flightlake.session import parse_day, prepare
from flightlake.sources import airports, bronze, tables

DELIVERY = "delivery"
# Fixed value: the folder of rows whose partition value is null.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Silver flights with the rest of their key, stored by flight date and delivery.
FLIGHTS_SCHEMA = T.StructType(
    [
        *[f for f in SILVER_SCHEMA if f.name != "flight_date"],
        T.StructField("first_seen", T.DoubleType()),
        T.StructField("last_seen", T.DoubleType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField(DELIVERY, T.StringType()),
    ]
)

BUILDERS = {
    AIRPORT_TRAFFIC: traffic.airport_traffic,
    COUNTRY_TRAFFIC: traffic.country_traffic,
    ROUTE_TRAFFIC: traffic.route_traffic,
}


@dataclass(frozen=True)
class DeliveryLake(Lake):
    """A lake whose gold covers a date's flights whenever they were delivered."""

    @property
    def flights(self) -> str:
        return f"{self.root}/deliveries/flights"

    @property
    def by_date(self) -> str:
        return f"{self.root}/deliveries/flights_enriched"


def delivered(batches: DataFrame, delivery: str) -> DataFrame:
    """The delivery's silver flights, the first of each record, with their whole key."""
    flights = silver.add_features(silver.remove_duplicates(silver.clean_flights(batches)))
    flights = flights.withColumns(
        {"processed_at": F.current_timestamp(), DELIVERY: F.lit(delivery)}
    )
    return flights.select(*[F.col(f.name).cast(f.dataType) for f in FLIGHTS_SCHEMA])


def partitions_of(spark: SparkSession, path: str, delivery: str) -> dict[tuple[str, ...], set[str]]:
    """A delivery's (flight date, delivery) partitions and files, by listing. The date of rows
    without one is NO_DATE."""
    files = tables.files_of(spark, f"{path}/*/{DELIVERY}={delivery}")
    return tables.files_by_partition(files, ["flight_date", DELIVERY])


def store(batches: DataFrame, path: str, delivery: str) -> list[dt.date]:
    """Write one delivery and return the flight dates it touches.

    Storing a delivery again replaces it: dates it no longer has flights of are emptied, and are
    among the dates returned.
    """
    spark = batches.sparkSession
    before = partitions_of(spark, path, delivery)
    flights = delivered(batches, delivery).hint("rebalance", F.col("flight_date"))
    tables.replace_files(flights, path, ["flight_date", DELIVERY], before)
    dates = sorted(day for day, _ in partitions_of(spark, path, delivery))
    return [parse_day(day) for day in dates if day != NO_DATE]


def first_deliveries(flights: DataFrame) -> DataFrame:
    """Of each record the first delivery. A delivery has a record once, so this is one row."""
    return silver.keep_first(flights, ["first_seen", "last_seen", "icao24"], [DELIVERY])


def flights_on(spark: SparkSession, path: str, days: Sequence[dt.date]) -> DataFrame:
    """All flights of the dates over all deliveries, each record once."""
    return first_deliveries(tables.read_dates(spark, path, FLIGHTS_SCHEMA, days))


def all_flights(spark: SparkSession, path: str) -> DataFrame:
    """All flights, those without a date included, each record once."""
    read = spark.read.schema(FLIGHTS_SCHEMA).parquet(path).select(*FLIGHTS_SCHEMA.names)
    return first_deliveries(read)


def refresh(
    spark: SparkSession,
    lake: DeliveryLake,
    days: Sequence[dt.date],
    lookup: DataFrame,
    gold: Iterable[GoldTable] = GOLD_TABLES,
) -> None:
    """Make the dates anew: enriched flights over all deliveries, and gold from these.

    The enriched flights are stored where several tables read them; a single one takes them as
    they are made.
    """
    if not days:
        return
    gold = list(gold)
    enriched = enrich.enrich_flights(flights_on(spark, lake.flights, days), lookup)
    if len(gold) != 1:
        order = [F.asc(c) for c in ("departure_time", "icao24")]
        tables.write_dates(enriched, lake.by_date, days, order)
        enriched = tables.read_dates(spark, lake.by_date, ENRICHED_SCHEMA, days)
    for table in gold:
        rows = traffic.enforce_schema(BUILDERS[table](enriched), table.schema)
        tables.write_dates(rows, lake.gold(table), days, history.ranking_order(table))


def take(
    spark: SparkSession,
    lake: DeliveryLake,
    batches: DataFrame,
    delivery: str,
    lookup: DataFrame,
    gold: Iterable[GoldTable] = GOLD_TABLES,
) -> list[dt.date]:
    """One delivery into silver and the gold of the dates it touches, which are returned.

    Deliveries are ordered by name, and a record is that of its first delivery. Taking a delivery
    again changes nothing; a corrected one replaces the old one's flights. Other dates' files are
    not touched.
    """
    days = store(batches, lake.flights, delivery)
    refresh(spark, lake, days, lookup, gold)
    return days


def read_lookup(spark: SparkSession, lake: Lake, na_tokens: Iterable[str] = ()) -> DataFrame:
    return enrich.build_lookup(airports.read_airports(spark, lake.airports_csv, na_tokens))


def run_delivery(
    spark: SparkSession, lake: DeliveryLake, day: str | dt.date, na_tokens: Iterable[str] = ()
) -> list[dt.date]:
    """The bronze batches of an ingestion date as one delivery. Late flights reach the gold of the
    date they departed on, and records delivered before count no more."""
    day = parse_day(day)
    batches = bronze.read_bronze(prepare(spark), lake.bronze, day, na_tokens)
    return take(spark, lake, batches, day.isoformat(), read_lookup(spark, lake, na_tokens))


