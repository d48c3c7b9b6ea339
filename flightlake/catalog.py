"""Registered queries: every operator of the data model over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions import numeric, text, times
from flightlake.operators import enrich, history, measures, silver, traffic, uniques
from flightlake.plans import deliveries, windows
from flightlake.schemas import (
    AIRPORT_TRAFFIC,
    BRONZE_COLUMNS,
    COUNTRY_TRAFFIC,
    DISTANCE_COLUMNS,
    ENRICHED_COLUMNS,
    FLIGHT_GRAIN,
    NUMERIC_COLUMNS,
    PAYLOAD_SCHEMA,
    PAYLOAD_TO_BRONZE,
    ROUTE_TRAFFIC,
    SILVER_COLUMNS,
)
from flightlake.session import prepare, shared_folder
from flightlake.sources import bronze as bronze_source
from flightlake.sources import payload, testdata
from flightlake.streaming import gold as stream

# The run date of the queries that process one day; the tables' flights span many years.
PROCESSING_DATE = "1995-07-12"


class Lakehouse:
    """The tables of one scale, each derived on demand from the ones before it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        events = testdata.table(self.spark, self.sf_dir, "events")
        return events.withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def orders(self) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, "orders")

    @cached_property
    def bronze(self) -> DataFrame:
        return testdata.bronze_flights(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return silver.clean_flights(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.build_silver(self.bronze)

    @cached_property
    def lookup(self) -> DataFrame:
        return enrich.build_lookup(testdata.airport_reference(self.spark, self.sf_dir))

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_flights(self.silver, self.lookup)

    @cached_property
    def airports(self) -> DataFrame:
        return traffic.airport_traffic(self.enriched)

    @cached_property
    def countries(self) -> DataFrame:
        return traffic.country_traffic(self.enriched)

    @cached_property
    def routes(self) -> DataFrame:
        return traffic.route_traffic(self.enriched)


    def folder(self) -> str:
        """A folder of its own, for a query that writes tables and reads them back."""
        return f"{shared_folder(self.spark)}/lake-{uuid.uuid4()}"


def _without_run_time(columns) -> list[str]:
    return [c for c in columns if c != "processed_at"]


def _plain_timestamps(df: DataFrame) -> DataFrame:
    """UTC timestamps without a zone, as other engines return them."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# Bronze -----------------------------------------------------------------------------------


def bronze_project(lake: Lakehouse) -> DataFrame:
    numbers = set(PAYLOAD_SCHEMA.names) - {
        "icao24",
        "callsign",
        "estDepartureAirport",
        "estArrivalAirport",
    } - {f for f, c in PAYLOAD_TO_BRONZE.items() if c in DISTANCE_COLUMNS}
    fields = [
        F.col(column).cast("long" if field in numbers else "string").alias(field)
        for field, column in PAYLOAD_TO_BRONZE.items()
    ]
    landed = lake.bronze.select(F.to_json(F.struct(*fields)).alias("json"))
    parsed = landed.select(F.from_json("json", PAYLOAD_SCHEMA).alias("flight"))
    return payload.project_payload(parsed.select("flight.*"))


def bronze_label(lake: Lakehouse) -> DataFrame:
    return windows.window_counts(lake.events, "ts")


def bronze_scan(lake: Lakehouse) -> DataFrame:
    return lake.bronze.select(*BRONZE_COLUMNS)


def bronze_lineage(lake: Lakehouse) -> DataFrame:
    return lake.bronze.select(*FLIGHT_GRAIN, "callsign", "bronze_file")


def bronze_union_by_name(lake: Lakehouse) -> DataFrame:
    """Batches whose columns come in another order, and one that lacks some."""
    keep = ["bronze_file", "row_order"]
    first = lake.bronze.where("bronze_file = 'a'").select(*BRONZE_COLUMNS[::-1], *keep)
    second = lake.bronze.where("bronze_file = 'b'").drop(*DISTANCE_COLUMNS)
    return bronze_source.union_by_name([first, second]).select(*BRONZE_COLUMNS, "bronze_file")


def bronze_batch_counts(lake: Lakehouse) -> DataFrame:
    return bronze_source.batch_counts(lake.bronze)


def bronze_batch_totals(lake: Lakehouse) -> DataFrame:
    return bronze_source.batch_totals(lake.bronze)


def normalize_headers(lake: Lakehouse) -> DataFrame:
    untidy = lake.bronze.select(
        *[F.col(c).alias(f" {c.upper().replace('_', ' ')}  ") for c in BRONZE_COLUMNS]
    )
    return bronze_source.normalize_headers(untidy)


def window_last_hour(lake: Lakehouse) -> DataFrame:
    planned = windows.last_hour(lake.events, "ts")
    return planned.groupBy("window_start", "window_end").agg(F.count("*").alias("runs"))


def window_day(lake: Lakehouse) -> DataFrame:
    days = lake.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("runs"), F.max("ts").alias("now")
    )
    planned = windows.whole_day(days, "day").withColumnsRenamed(
        {"window_start": "day_start", "window_end": "day_end"}
    )
    planned = windows.previous_day(planned, "now").withColumnsRenamed(
        {"window_start": "previous_start", "window_end": "previous_end"}
    )
    return planned.drop("now")


def window_backfill_plan(lake: Lakehouse) -> DataFrame:
    days = lake.events.select(F.to_date("ts").alias("day")).distinct()
    return windows.backfill_plan(days, "day")


def backfill_coverage(lake: Lakehouse) -> DataFrame:
    departed = lake.silver.where(F.col("departure_time").isNotNull())
    counts = windows.window_counts(departed, "departure_time").select("bronze_file", "row_count")
    days = departed.select(F.to_date("departure_time").alias("day")).distinct()
    return windows.plan_coverage(windows.backfill_plan(days, "day"), counts)


# Silver -----------------------------------------------------------------------------------


def clean_strings(lake: Lakehouse) -> DataFrame:
    return silver.clean_strings(lake.bronze).select(*BRONZE_COLUMNS[:6], "bronze_file")


def blank_to_null(lake: Lakehouse) -> DataFrame:
    return lake.bronze.select(
        *[text.blank_to_null(F.col(c)).alias(c) for c in BRONZE_COLUMNS], "bronze_file"
    )


def to_numeric_coerce(lake: Lakehouse) -> DataFrame:
    return silver.convert_numbers(lake.bronze).select("icao24", "callsign", *NUMERIC_COLUMNS)


def nan_to_null(lake: Lakehouse) -> DataFrame:
    distance = F.col("arrival_airport_horiz_distance").try_cast("double")
    return lake.bronze.select(
        *FLIGHT_GRAIN, "bronze_file", numeric.nan_to_null(distance).alias("distance")
    )


def epoch_to_timestamp(lake: Lakehouse) -> DataFrame:
    times_only = silver.convert_timestamps(silver.convert_numbers(lake.bronze))
    return times_only.select(
        "icao24", "bronze_file", "first_seen", "last_seen", "departure_time", "arrival_time"
    )


def validate_time_order(lake: Lakehouse) -> DataFrame:
    times_only = silver.convert_timestamps(silver.convert_numbers(lake.bronze))
    return silver.validate_time_order(times_only).select(
        "icao24", "bronze_file", "first_seen", "last_seen", "departure_time", "arrival_time"
    )


def validate_non_negative(lake: Lakehouse) -> DataFrame:
    numbers = silver.convert_numbers(lake.bronze)
    return silver.validate_distances(numbers).select(*FLIGHT_GRAIN, *DISTANCE_COLUMNS)


def dedup_first(lake: Lakehouse) -> DataFrame:
    return silver.remove_duplicates(lake.clean).select(
        *FLIGHT_GRAIN, "callsign", "departure_airport", "arrival_airport", "bronze_file"
    )


def flight_duration(lake: Lakehouse) -> DataFrame:
    return silver.add_features(lake.clean).select(
        "icao24", "departure_time", "arrival_time", "flight_duration_minutes"
    )


def route_key(lake: Lakehouse) -> DataFrame:
    return silver.add_features(lake.clean).select(
        "icao24", "first_seen", "departure_airport", "arrival_airport", "route"
    )


def time_features(lake: Lakehouse) -> DataFrame:
    return silver.add_features(lake.clean).select(
        "icao24", "first_seen", "departure_time", "flight_date", "departure_hour"
    )


def silver_flights(lake: Lakehouse) -> DataFrame:
    return lake.silver.select(*_without_run_time(SILVER_COLUMNS))


def silver_quality(lake: Lakehouse) -> DataFrame:
    return silver.silver_quality(lake.bronze)


# Enrichment -------------------------------------------------------------------------------


def airport_lookup(lake: Lakehouse) -> DataFrame:
    return lake.lookup


def enrich_departure(lake: Lakehouse) -> DataFrame:
    return enrich.enrich_departure(lake.silver, lake.lookup).drop("processed_at")


def enrich_arrival(lake: Lakehouse) -> DataFrame:
    return enrich.enrich_arrival(lake.silver, lake.lookup).drop("processed_at")


def enriched_flights(lake: Lakehouse) -> DataFrame:
    return lake.enriched.select(*_without_run_time(ENRICHED_COLUMNS))


def enrichment_match_stats(lake: Lakehouse) -> DataFrame:
    return enrich.match_stats(lake.enriched, lake.lookup)


# Gold -------------------------------------------------------------------------------------


def coerce_date(lake: Lakehouse) -> DataFrame:
    written = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    dated = lake.orders.select("o_orderkey", written.alias("flight_date"))
    return traffic.coerce_flight_date(dated).select(
        "o_orderkey", "flight_date", F.date_format("flight_date", "yyyy-MM-dd").alias("date_text")
    )


def filter_processing_date(lake: Lakehouse) -> DataFrame:
    flights = traffic.filter_date(lake.enriched, PROCESSING_DATE)
    return flights.select(*_without_run_time(ENRICHED_COLUMNS))


def enforce_schema(lake: Lakehouse) -> DataFrame:
    older = lake.airports.select(
        "unique_aircraft",
        F.col("flight_date").cast("string"),
        F.lit("obsolete").alias("comment"),
        *[c for c in lake.airports.columns if c not in ("flight_date", "unique_aircraft")],
    )
    return traffic.enforce_schema(older, AIRPORT_TRAFFIC.schema)


def airport_outer_merge(lake: Lakehouse) -> DataFrame:
    return traffic.merge_roles(
        traffic.airport_departures(lake.enriched),
        traffic.airport_arrivals(lake.enriched),
        ["flight_date", "airport", "country"],
    )


def country_outer_merge(lake: Lakehouse) -> DataFrame:
    return traffic.merge_roles(
        traffic.country_departures(lake.enriched),
        traffic.country_arrivals(lake.enriched),
        ["flight_date", "country"],
    )


def gold_run_stats(lake: Lakehouse) -> DataFrame:
    flights = traffic.filter_date(lake.enriched, PROCESSING_DATE)
    return traffic.run_stats(
        lake.enriched,
        PROCESSING_DATE,
        traffic.airport_traffic(flights),
        traffic.country_traffic(flights),
        traffic.route_traffic(flights),
    )


def _on_run_date() -> Column:
    return F.col("flight_date") == F.lit(PROCESSING_DATE).cast("date")


def _outdated(gold: DataFrame, table) -> DataFrame:
    """Gold as earlier runs might have left it: wrong on the processing date, and on other dates
    not what a run would give today, which must survive."""
    metric = F.col(table.metric)
    return gold.withColumn(
        table.metric, F.when(_on_run_date(), metric + 1000).otherwise(metric + 1)
    )


def _replaced(gold: DataFrame, table) -> DataFrame:
    return history.replace_date(_outdated(gold, table), gold, PROCESSING_DATE, table)


def _upserted(gold: DataFrame, table) -> DataFrame:
    """The target lacks some keys of the date, which are inserted, and the batch lacks others,
    which stay as they were."""
    target = _outdated(gold, table).where(~(_on_run_date() & (F.col("unique_aircraft") > 1)))
    batch = traffic.filter_date(gold, PROCESSING_DATE).where(F.col(table.metric) % 3 != 0)
    return history.upsert(target, batch, table.key)


# Stored -----------------------------------------------------------------------------------


def _made_once(lake: Lakehouse, gold: DataFrame) -> DataFrame:
    """Gold stored as it is, for queries that write more than one table from it."""
    path = lake.folder()
    gold.write.parquet(path)
    return lake.spark.read.schema(gold.schema).parquet(path)


def _stored_replaced(lake: Lakehouse, gold: DataFrame, table) -> DataFrame:
    """What `_replaced` gives, by way of the stored table."""
    path = lake.folder()
    gold = _made_once(lake, gold)
    history.write_gold(_outdated(gold, table), path, table)
    history.write_gold_day(gold, path, PROCESSING_DATE, table)
    return history.read_gold(lake.spark, path, table)


def _stored_upserted(lake: Lakehouse, gold: DataFrame, table) -> DataFrame:
    """What `_upserted` gives, by way of stored tables."""
    folder = lake.folder()
    gold = _made_once(lake, gold)
    target = _outdated(gold, table).where(~(_on_run_date() & (F.col("unique_aircraft") > 1)))
    history.write_gold(target, f"{folder}/target", table)
    batch = traffic.filter_date(gold, PROCESSING_DATE).where(F.col(table.metric) % 3 != 0)
    history.write_gold(batch, f"{folder}/batch", table)
    stored = history.read_gold(lake.spark, f"{folder}/batch", table)
    history.upsert_gold(lake.spark, stored, f"{folder}/target", table)
    return history.read_gold(lake.spark, f"{folder}/target", table)


def _bronze_of_delivery(lake: Lakehouse, batch: str) -> DataFrame:
    """One of the two deliveries, its row order in the form of landed files."""
    line = F.col("row_order.l_linenumber").cast("long")
    order = F.struct(
        F.lit(None).cast("string").alias("part"),
        F.col("row_order.o_orderkey").cast("long").alias("block"),
        (F.shiftleft(line, 40) + F.col("row_order.l_partkey")).alias("id"),
    )
    some = testdata.bronze_flights(lake.spark, lake.sf_dir, batch)
    return some.withColumn("row_order", order)


def _delivered(lake: Lakehouse) -> deliveries.DeliveryLake:
    """Both deliveries stored one after the other, the second of which repeats many records."""
    stored = deliveries.DeliveryLake(lake.folder(), "")
    for batch in ("a", "b"):
        deliveries.store(_bronze_of_delivery(lake, batch), stored.flights, batch)
    return stored


def silver_across_deliveries(lake: Lakehouse) -> DataFrame:
    flights = deliveries.all_flights(lake.spark, _delivered(lake).flights)
    return flights.select(*_without_run_time(SILVER_COLUMNS))


def late_gold_country(lake: Lakehouse) -> DataFrame:
    """Gold of the dates that the later, smaller delivery touches, refreshed over both."""
    stored = deliveries.DeliveryLake(lake.folder(), "")
    first, second = (_bronze_of_delivery(lake, b) for b in ("a", "b"))
    late = F.col("row_order.block") % 3 == 0
    parts = {"1": first.where(~late), "2": first.where(late).unionByName(second)}
    for name, batches in parts.items():
        deliveries.take(lake.spark, stored, batches, name, lake.lookup, [COUNTRY_TRAFFIC])
    return history.read_gold(lake.spark, stored.gold(COUNTRY_TRAFFIC), COUNTRY_TRAFFIC)


def stream_gold(lake: Lakehouse) -> DataFrame:
    """Two batches land one after the other; the stream takes in each when it has come."""
    stored = deliveries.DeliveryLake(lake.folder(), "")
    hours = {"a": "00-00_to_02-00", "b": "02-00_to_04-00"}
    for batch, window in hours.items():
        name = f"flights_{PROCESSING_DATE}_{window}.csv"
        rows = _bronze_of_delivery(lake, batch).withColumn("bronze_file", F.lit(name))
        bronze_source.write_landed(rows, stored.bronze, PROCESSING_DATE, [name])
        stream.catch_up(lake.spark, stored, lake.lookup, [AIRPORT_TRAFFIC])
    return history.read_gold(lake.spark, stored.gold(AIRPORT_TRAFFIC), AIRPORT_TRAFFIC)


# Aircraft over spans of dates -------------------------------------------------------------


def _bitmaps(lake: Lakehouse, dimension: str) -> DataFrame:
    return uniques.daily_bitmaps(lake.enriched, uniques.number_aircraft(lake.silver), dimension)


def aircraft_by_month_airport(lake: Lakehouse) -> DataFrame:
    return uniques.aircraft_by_month(_bitmaps(lake, "airport"), "airport")


def aircraft_in_span_country(lake: Lakehouse) -> DataFrame:
    return uniques.aircraft_between(_bitmaps(lake, "country"), "country", "1994-01-01", "1996-12-31")


# Dashboard --------------------------------------------------------------------------------


def slice_gold(lake: Lakehouse) -> DataFrame:
    return measures.slice_rows(
        lake.airports,
        first_date="1994-01-01",
        last_date="1996-12-31",
        country=["ASIA", "EUROPE"],
    )


def slice_routes(lake: Lakehouse) -> DataFrame:
    return measures.slice_rows(
        lake.routes, departure_airport="NATION_3", arrival_airport=["NATION_4", "NATION_5"]
    )


def rank_airports_by_aircraft(lake: Lakehouse) -> DataFrame:
    ranks = {"total_traffic": "traffic_rank", "unique_aircraft": "aircraft_rank"}
    return measures.rank_per_day(lake.airports, ranks)


def rank_countries_by_aircraft(lake: Lakehouse) -> DataFrame:
    ranks = {"total_traffic": "traffic_rank", "unique_aircraft": "aircraft_rank"}
    return measures.rank_per_day(lake.countries, ranks)


QUERIES: dict[str, Callable[[Lakehouse], DataFrame]] = {
    "bronze_project": bronze_project,
    "bronze_label": bronze_label,
    "bronze_scan": bronze_scan,
    "bronze_lineage": bronze_lineage,
    "bronze_union_by_name": bronze_union_by_name,
    "bronze_batch_counts": bronze_batch_counts,
    "bronze_batch_totals": bronze_batch_totals,
    "normalize_headers": normalize_headers,
    "window_last_hour": window_last_hour,
    "window_day": window_day,
    "window_backfill_plan": window_backfill_plan,
    "backfill_coverage": backfill_coverage,
    "clean_strings": clean_strings,
    "blank_to_null": blank_to_null,
    "to_numeric_coerce": to_numeric_coerce,
    "nan_to_null": nan_to_null,
    "epoch_to_timestamp": epoch_to_timestamp,
    "validate_time_order": validate_time_order,
    "validate_non_negative": validate_non_negative,
    "dedup_first": dedup_first,
    "flight_duration": flight_duration,
    "route_key": route_key,
    "time_features": time_features,
    "silver_flights": silver_flights,
    "silver_quality": silver_quality,
    "airport_lookup": airport_lookup,
    "enrich_departure": enrich_departure,
    "enrich_arrival": enrich_arrival,
    "enriched_flights": enriched_flights,
    "enrichment_match_stats": enrichment_match_stats,
    "coerce_date": coerce_date,
    "filter_processing_date": filter_processing_date,
    "enforce_schema": enforce_schema,
    "airport_departures": lambda lake: traffic.airport_departures(lake.enriched),
    "airport_arrivals": lambda lake: traffic.airport_arrivals(lake.enriched),
    "airport_outer_merge": airport_outer_merge,
    "airport_unique_aircraft": lambda lake: traffic.unique_aircraft(lake.enriched, "airport"),
    "airport_traffic": lambda lake: lake.airports,
    "country_departures": lambda lake: traffic.country_departures(lake.enriched),
    "country_arrivals": lambda lake: traffic.country_arrivals(lake.enriched),
    "country_outer_merge": country_outer_merge,
    "country_unique_aircraft": lambda lake: traffic.unique_aircraft(lake.enriched, "country"),
    "country_traffic": lambda lake: lake.countries,
    "route_traffic": lambda lake: lake.routes,
    "gold_run_stats": gold_run_stats,
    "gold_replace_airport": lambda lake: _replaced(lake.airports, AIRPORT_TRAFFIC),
    "gold_replace_country": lambda lake: _replaced(lake.countries, COUNTRY_TRAFFIC),
    "gold_replace_route": lambda lake: _replaced(lake.routes, ROUTE_TRAFFIC),
    "gold_history_sorted": lambda lake: history.history_sorted(lake.airports, AIRPORT_TRAFFIC),
    "upsert_airport": lambda lake: _upserted(lake.airports, AIRPORT_TRAFFIC),
    "upsert_country": lambda lake: _upserted(lake.countries, COUNTRY_TRAFFIC),
    "upsert_route": lambda lake: _upserted(lake.routes, ROUTE_TRAFFIC),
    "top10_airports": lambda lake: measures.top_k(lake.airports, AIRPORT_TRAFFIC),
    "top10_countries": lambda lake: measures.top_k(lake.countries, COUNTRY_TRAFFIC),
    "top10_routes": lambda lake: measures.top_k(lake.routes, ROUTE_TRAFFIC),
    "daily_top10_airports": lambda lake: measures.top_k_per_day(lake.airports, AIRPORT_TRAFFIC),
    "daily_top10_routes": lambda lake: measures.top_k_per_day(lake.routes, ROUTE_TRAFFIC),
    "kpi_global": lambda lake: measures.kpi_global(lake.airports, lake.routes),
    "kpi_airport": lambda lake: measures.kpi_airport(lake.enriched),
    "kpi_country": lambda lake: measures.kpi_country(lake.enriched),
    "kpi_route": lambda lake: measures.kpi_route(lake.enriched),
    "slice_gold": slice_gold,
    "slice_routes": slice_routes,
    "rank_airports_by_aircraft": rank_airports_by_aircraft,
    "rank_countries_by_aircraft": rank_countries_by_aircraft,
    "arrivals_vs_departures": lambda lake: measures.arrivals_vs_departures(
        lake.countries, "country"
    ),
    "trend_airport": lambda lake: measures.trend(lake.airports, AIRPORT_TRAFFIC),
    "trend_route": lambda lake: measures.trend(lake.routes, ROUTE_TRAFFIC),
    "calendar_trend_airport": lambda lake: measures.calendar_trend(lake.airports, AIRPORT_TRAFFIC),
    "calendar_trend_route": lambda lake: measures.calendar_trend(lake.routes, ROUTE_TRAFFIC),
    "kpi_cube": lambda lake: measures.kpi_cube(lake.enriched),
    "aircraft_by_month_airport": aircraft_by_month_airport,
    "aircraft_in_span_country": aircraft_in_span_country,
    "silver_across_deliveries": silver_across_deliveries,
    "late_gold_country": late_gold_country,
    "stream_gold": stream_gold,
    "stored_replace_airport": lambda lake: _stored_replaced(lake, lake.airports, AIRPORT_TRAFFIC),
    "stored_replace_country": lambda lake: _stored_replaced(lake, lake.countries, COUNTRY_TRAFFIC),
    "stored_replace_route": lambda lake: _stored_replaced(lake, lake.routes, ROUTE_TRAFFIC),
    "stored_upsert_airport": lambda lake: _stored_upserted(lake, lake.airports, AIRPORT_TRAFFIC),
    "stored_upsert_country": lambda lake: _stored_upserted(lake, lake.countries, COUNTRY_TRAFFIC),
    "stored_upsert_route": lambda lake: _stored_upserted(lake, lake.routes, ROUTE_TRAFFIC),
    "routes_between_top_airports": lambda lake: measures.routes_between_top_airports(
        lake.airports, lake.routes
    ),
}


# Queries that write tables and read them back.
STORED = {name for name in QUERIES if name.startswith("stored_")} | {
    "silver_across_deliveries",
    "late_gold_country",
    "stream_gold",
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_timestamps(QUERIES[name](Lakehouse(spark, sf_dir)))
