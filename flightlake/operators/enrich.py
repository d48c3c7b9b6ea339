"""Airport names, IATA codes and countries for both ends of every flight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions import numeric, text
from flightlake.operators.silver import keep_first
from flightlake.schemas import ENRICHED_COLUMNS, LOOKUP_COLUMNS
from flightlake.session import shuffle_partitions
from flightlake.sources.bronze import ROW_ORDER

# A lookup up to this many bytes, as a hash table, is copied to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# What a row costs in a hash table beside its text: key, pointers, row header and null bits.
ROW_BYTES = 128

# Beyond it, every airport is spread over a share of the shuffle's partitions, which are copies
# of the lookup's rows.
PARTITIONS_PER_SALT = 8
MOST_SALTS = 1024

DEPARTURE = {
    "airport_iata": "departure_iata",
    "airport_name": "departure_airport_name",
    "country_code": "departure_country",
}
ARRIVAL = {
    "airport_iata": "arrival_iata",
    "airport_name": "arrival_airport_name",
    "country_code": "arrival_country",
}


def clean_airports(airports: DataFrame) -> DataFrame:
    """Codes stripped, upper-cased and blank -> null; the name stays as it is."""
    return airports.withColumns(
        {c: text.code(F.col(c)) for c in ("ident", "icao_code", "iata_code", "iso_country")}
    )


def airport_lookup(airports: DataFrame) -> DataFrame:
    """One row per ICAO code, the first in the reference's row order."""
    coded = airports.select(
        F.col("icao_code").alias("airport_code"),
        F.col("iata_code").alias("airport_iata"),
        F.col("name").alias("airport_name"),
        F.col("iso_country").alias("country_code"),
        ROW_ORDER,
    ).where(F.col("airport_code").isNotNull())
    return keep_first(coded, ["airport_code"], [ROW_ORDER]).select(*LOOKUP_COLUMNS)


def build_lookup(airports: DataFrame) -> DataFrame:
    return airport_lookup(clean_airports(airports))


def table_bytes(df: DataFrame) -> int:
    """Estimated bytes of `df` as a hash table: its text and ROW_BYTES a row, by one
    distributed aggregate."""
    row = F.lit(ROW_BYTES)
    for column in df.columns:
        row = row + F.coalesce(F.octet_length(column), F.lit(0))
    return df.agg(numeric.count_or_zero(F.sum(row)).alias("bytes")).first()["bytes"]


def is_broadcastable(lookup: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return table_bytes(lookup) <= limit


def salts_for(partitions: int) -> int:
    return max(1, min(partitions // PARTITIONS_PER_SALT, MOST_SALTS))


def _join_role(flights, lookup, code_column, renames, small, salts) -> DataFrame:
    role = lookup.select(
        F.col("airport_code").alias(code_column),
        *[F.col(c).alias(name) for c, name in renames.items()],
    )
    if small:
        return flights.join(F.broadcast(role), code_column, "left")
    # A busy airport may hold much of the table. The salt comes from the row itself, so a
    # retried task sends every row where the first try sent it. Flights without an airport match
    # nothing and are not shuffled.
    known = flights.where(F.col(code_column).isNotNull())
    salted = known.withColumn("_salt", F.pmod(F.xxhash64(*flights.columns), F.lit(salts)))
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")
    copies = role.withColumn("_salt", F.explode(every_salt))
    joined = salted.join(copies, [code_column, "_salt"], "left").drop("_salt")
    unknown = flights.where(F.col(code_column).isNull()).withColumns(
        {name: F.lit(None).cast(role.schema[name].dataType) for name in renames.values()}
    )
    return joined.unionByName(unknown)


def _settled(lookup: DataFrame, small: bool | None, salts: int | None) -> tuple[bool, int]:
    """Both choices, made here where the caller did not; only then a job runs."""
    small = is_broadcastable(lookup) if small is None else small
    return small, salts or salts_for(shuffle_partitions(lookup.sparkSession))


def enrich_departure(
    flights, lookup, small: bool | None = None, salts: int | None = None
) -> DataFrame:
    choices = _settled(lookup, small, salts)
    joined = _join_role(flights, lookup, "departure_airport", DEPARTURE, *choices)
    return joined.select(*flights.columns, *DEPARTURE.values())


def enrich_arrival(
    flights, lookup, small: bool | None = None, salts: int | None = None
) -> DataFrame:
    choices = _settled(lookup, small, salts)
    joined = _join_role(flights, lookup, "arrival_airport", ARRIVAL, *choices)
    return joined.select(*flights.columns, *ARRIVAL.values())


def enrich_flights(
    flights: DataFrame, lookup: DataFrame, small: bool | None = None, salts: int | None = None
) -> DataFrame:
    """Both ends; every flight stays, unmatched ends stay null.

    A small lookup (`is_broadcastable`, measured here unless the caller has done so) is
    broadcast and the flights are not shuffled at all; otherwise both joins are salted.
    """
    choices = _settled(lookup, small, salts)
    both = enrich_arrival(enrich_departure(flights, lookup, *choices), lookup, *choices)
    return both.select(*[c for c in ENRICHED_COLUMNS if c in both.columns])


def match_stats(enriched: DataFrame, lookup: DataFrame) -> DataFrame:
    """Flights matched at each end, and the size of the lookup."""
    return enriched.agg(
        F.count("*").alias("flights"),
        F.count("departure_airport_name").alias("departures_matched"),
        F.count("arrival_airport_name").alias("arrivals_matched"),
    ).select("*", lookup.agg(F.count("*")).scalar().alias("lookup_rows"))
