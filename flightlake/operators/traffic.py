"""Silver to gold: airport, country and route traffic per day.

A flight is turned into its movements, one per end, by a single pass. Counting goes in two
steps: first per aircraft, then per airport or country. After the first step an aircraft is
one row of its group, so exact distinct counts are plain counts, several of them need no row
copies, and a hot airport is spread over its aircraft. A hot aircraft, or a missing id, is
folded on the map side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.numeric import count_or_zero
from flightlake.functions.times import to_date_or_null
from flightlake.schemas import (
    AIRPORT_TRAFFIC_SCHEMA,
    COUNTRY_TRAFFIC_SCHEMA,
    ROUTE_TRAFFIC_SCHEMA,
)
from flightlake.session import parse_day


def enforce_schema(df: DataFrame, schema) -> DataFrame:
    """Exactly the declared columns: others are dropped, a missing one is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def coerce_flight_date(df: DataFrame) -> DataFrame:
    """A textual flight_date becomes a DATE, or null where it is none."""
    if dict(df.dtypes)["flight_date"] == "date":
        return df
    return df.withColumn("flight_date", to_date_or_null(F.col("flight_date")))


def filter_date(df: DataFrame, day: str | dt.date) -> DataFrame:
    return df.where(F.col("flight_date") == F.lit(parse_day(day)))


def all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for column in columns:
        known = known & F.col(column).isNotNull()
    return known


def movements(enriched: DataFrame) -> DataFrame:
    """(flight_date, airport, country, icao24, is_departure), one row per end of a flight."""

    def end(airport: str, country: str, is_departure: bool) -> Column:
        return F.struct(
            F.col(airport).alias("airport"),
            F.col(country).alias("country"),
            F.lit(is_departure).alias("is_departure"),
        )

    ends = F.array(
        end("departure_airport", "departure_country", True),
        end("arrival_airport", "arrival_country", False),
    )
    return enriched.select("flight_date", "icao24", F.explode(ends).alias("end")).select(
        "flight_date", "end.airport", "end.country", "icao24", "end.is_departure"
    )


def aircraft_activity(moves: DataFrame, group: Sequence[str]) -> DataFrame:
    """Departures and arrivals per group and aircraft. Groups with a null key are dropped;
    an unknown aircraft is kept, because it can be all a group has."""
    return (
        moves.where(all_known(group))
        .groupBy(*group, "icao24")
        .agg(
            F.count_if("is_departure").alias("n_departures"),
            F.count_if(~F.col("is_departure")).alias("n_arrivals"),
        )
    )


def traffic_of(activity: DataFrame, group: Sequence[str]) -> DataFrame:
    """Counts per group from activity with one row per group and aircraft."""
    known = F.col("icao24").isNotNull()
    return (
        activity.groupBy(*group)
        .agg(
            count_or_zero(F.sum(F.when(known, F.col("n_departures")))).alias("departures"),
            F.count_if(known & (F.col("n_departures") > 0)).alias("departure_aircraft"),
            count_or_zero(F.sum(F.when(known, F.col("n_arrivals")))).alias("arrivals"),
            F.count_if(known & (F.col("n_arrivals") > 0)).alias("arrival_aircraft"),
            F.count("icao24").alias("unique_aircraft"),
        )
        .withColumn("total_traffic", F.col("departures") + F.col("arrivals"))
    )


AIRPORT_GROUP = ["flight_date", "airport", "country"]
COUNTRY_GROUP = ["flight_date", "country"]


def airport_activity(enriched: DataFrame) -> DataFrame:
    """Departures and arrivals per date, airport, country and aircraft, which airport and
    country traffic both count."""
    return aircraft_activity(movements(enriched), AIRPORT_GROUP)


def airport_traffic(enriched: DataFrame) -> DataFrame:
    traffic = traffic_of(airport_activity(enriched), AIRPORT_GROUP)
    return enforce_schema(traffic, AIRPORT_TRAFFIC_SCHEMA)


def country_activity(airports: DataFrame) -> DataFrame:
    """Airport activity folded to countries. An airport outside the lookup has no country, so
    a known country implies a known airport and no movement is missed."""
    return airports.groupBy(*COUNTRY_GROUP, "icao24").agg(
        F.sum("n_departures").alias("n_departures"), F.sum("n_arrivals").alias("n_arrivals")
    )


def country_traffic(enriched: DataFrame) -> DataFrame:
    traffic = traffic_of(country_activity(airport_activity(enriched)), COUNTRY_GROUP)
    return enforce_schema(traffic, COUNTRY_TRAFFIC_SCHEMA)


def route_traffic(enriched: DataFrame) -> DataFrame:
    """Routes need both airports, not a match in the lookup. The single distinct count takes
    part in Spark's own two-step aggregation, spread over aircraft like the others."""
    keys = ["flight_date", "departure_airport", "arrival_airport", "route"]
    traffic = (
        enriched.where(all_known(keys))
        .groupBy(*keys)
        .agg(
            F.count("icao24").alias("flight_count"),
            F.count_distinct("icao24").alias("unique_aircraft"),
        )
    )
    return enforce_schema(traffic, ROUTE_TRAFFIC_SCHEMA)


# One role at a time -----------------------------------------------------------------------


def _role_traffic(enriched, sources: dict[str, str], flights_as: str, aircraft_as: str):
    """Flights and distinct aircraft grouped by `sources`, whose columns get new names."""
    return (
        enriched.where(all_known(list(sources)))
        .groupBy(*[F.col(c).alias(name) for c, name in sources.items()])
        .agg(
            F.count("icao24").alias(flights_as),
            F.count_distinct("icao24").alias(aircraft_as),
        )
    )


def airport_departures(enriched: DataFrame) -> DataFrame:
    sources = {
        "flight_date": "flight_date",
        "departure_airport": "airport",
        "departure_country": "country",
    }
    return _role_traffic(enriched, sources, "departures", "departure_aircraft")


def airport_arrivals(enriched: DataFrame) -> DataFrame:
    sources = {
        "flight_date": "flight_date",
        "arrival_airport": "airport",
        "arrival_country": "country",
    }
    return _role_traffic(enriched, sources, "arrivals", "arrival_aircraft")


def country_departures(enriched: DataFrame) -> DataFrame:
    sources = {"flight_date": "flight_date", "departure_country": "country"}
    return _role_traffic(enriched, sources, "departures", "departure_aircraft")


def country_arrivals(enriched: DataFrame) -> DataFrame:
    sources = {"flight_date": "flight_date", "arrival_country": "country"}
    return _role_traffic(enriched, sources, "arrivals", "arrival_aircraft")


def merge_roles(departures: DataFrame, arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Departures and arrivals side by side; a role without flights counts zero."""
    merged = departures.join(arrivals, list(keys), "full_outer")
    metrics = ["departures", "departure_aircraft", "arrivals", "arrival_aircraft"]
    return merged.select(
        *keys, *[count_or_zero(F.col(m)).alias(m) for m in metrics]
    ).withColumn("total_traffic", F.col("departures") + F.col("arrivals"))


def unique_aircraft(enriched: DataFrame, dimension: str) -> DataFrame:
    """Distinct aircraft per day and airport or country, whichever end they were seen at."""
    keys = ["flight_date", dimension]
    return (
        movements(enriched)
        .where(all_known(keys))
        .groupBy(*keys)
        .agg(F.count_distinct("icao24").alias("unique_aircraft"))
    )


def run_stats(enriched, day, airports, countries, routes) -> DataFrame:
    """Rows before and after the date filter, and rows of each gold table of that day."""
    on_day = F.col("flight_date") == F.lit(parse_day(day))

    def rows(table: DataFrame) -> Column:
        return table.agg(F.count("*")).scalar()

    return enriched.agg(
        F.count("*").alias("rows_before_filter"), F.count_if(on_day).alias("rows_after_filter")
    ).select(
        "*",
        rows(airports).alias("airport_rows"),
        rows(countries).alias("country_rows"),
        rows(routes).alias("route_rows"),
    )
