"""Bronze to silver: clean, validate, deduplicate, derive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from flightlake.functions import numeric, text, times
from flightlake.schemas import (
    CODE_COLUMNS,
    DISTANCE_COLUMNS,
    FLIGHT_GRAIN,
    NUMERIC_COLUMNS,
    SILVER_SCHEMA,
)
from flightlake.sources.bronze import LINEAGE, ROW_ORDER


def clean_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.code(F.col(c)) for c in CODE_COLUMNS})


def convert_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: numeric.to_double(F.col(c)) for c in NUMERIC_COLUMNS})


def convert_timestamps(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "departure_time": times.epoch_to_timestamp(F.col("first_seen")),
            "arrival_time": times.epoch_to_timestamp(F.col("last_seen")),
        }
    )


def validate_time_order(df: DataFrame) -> DataFrame:
    """Both times are dropped, and the row kept, where arrival precedes departure."""
    ordered = times.in_time_order(F.col("departure_time"), F.col("arrival_time"))
    return df.withColumns(
        {c: F.when(ordered, F.col(c)) for c in ("departure_time", "arrival_time")}
    )


def validate_distances(df: DataFrame) -> DataFrame:
    return df.withColumns({c: numeric.non_negative(F.col(c)) for c in DISTANCE_COLUMNS})


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in `order`; null keys equal each other.

    Asking for row number 1 lets Spark drop all but one row per key and task before the
    shuffle, so a key holding much of the table costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One row per flight record. The epochs lead the sort: being nearly unique numbers, they
    settle most comparisons without a look at the rows."""
    return keep_first(df, ["first_seen", "last_seen", "icao24"], [LINEAGE, ROW_ORDER])


def add_features(df: DataFrame) -> DataFrame:
    departure, arrival = F.col("departure_time"), F.col("arrival_time")
    return df.withColumns(
        {
            "flight_duration_minutes": times.minutes_between(departure, arrival),
            "route": text.route(F.col("departure_airport"), F.col("arrival_airport")),
            "flight_date": F.to_date(departure),
            "departure_hour": F.hour(departure),
        }
    )


def clean_flights(bronze: DataFrame) -> DataFrame:
    """Everything that looks at one row only and comes before deduplication."""
    return validate_distances(
        validate_time_order(convert_timestamps(convert_numbers(clean_strings(bronze))))
    )


def build_silver(bronze: DataFrame) -> DataFrame:
    """Bronze batches to the silver table. One shuffle, for the deduplication; cleaned
    columns that silver does not keep are pruned before they are computed.

    Timestamps are made before the shuffle, although their epochs would do to carry them:
    a filter on them then stays above the window instead of being pushed below it as a copy
    of all the parsing.
    """
    flights = add_features(remove_duplicates(clean_flights(bronze)))
    flights = flights.withColumn("processed_at", F.current_timestamp())
    return flights.select(*[F.col(f.name).cast(f.dataType) for f in SILVER_SCHEMA])


class SilverCounts:
    """Counts of a silver run, taken while its rows are written.

    `observed` frames carry the counts along; `counts` has them once they were written. They are
    those of `silver_quality`, without another scan. Rows read are counted before the shuffle: if
    an executor is lost and a task there runs again, its rows count again, so a report over
    such a run belongs to `silver_quality`.
    """

    def __init__(self):
        self.read, self.kept = Observation(), Observation()

    def observed_bronze(self, bronze: DataFrame) -> DataFrame:
        return bronze.observe(self.read, F.count(F.lit(1)).alias("rows"))

    def observed_silver(self, flights: DataFrame) -> DataFrame:
        return flights.observe(
            self.kept,
            F.count(F.lit(1)).alias("rows_after"),
            F.count("departure_airport").alias("rows_with_departure"),
            F.count("arrival_airport").alias("rows_with_arrival"),
            F.count("route").alias("rows_with_route"),
        )

    def counts(self) -> dict[str, int]:
        kept = self.kept.get
        return {"duplicates_removed": self.read.get["rows"] - kept["rows_after"], **kept}


def silver_quality(bronze: DataFrame) -> DataFrame:
    """What cleaning did: duplicates removed, rows left, rows with each airport and a route.

    One pass: per flight the number of copies and the flags of the first one, then totals.
    """
    flags = add_features(clean_flights(bronze)).select(
        *FLIGHT_GRAIN,
        F.struct(
            LINEAGE,
            ROW_ORDER,
            F.col("departure_airport").isNotNull().alias("has_departure"),
            F.col("arrival_airport").isNotNull().alias("has_arrival"),
            F.col("route").isNotNull().alias("has_route"),
        ).alias("copy"),
    )
    flights = flags.groupBy(*FLIGHT_GRAIN).agg(
        F.count("*").alias("copies"), F.min("copy").alias("first")
    )
    return flights.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count("*").alias("rows_after"),
        F.count_if("first.has_departure").alias("rows_with_departure"),
        F.count_if("first.has_arrival").alias("rows_with_arrival"),
        F.count_if("first.has_route").alias("rows_with_route"),
    )
