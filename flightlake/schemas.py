"""Column lists, keys and types of every table in the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload field -> bronze column, in bronze column order.
PAYLOAD_TO_BRONZE = {
    "icao24": "icao24",
    "firstSeen": "first_seen",
    "estDepartureAirport": "departure_airport",
    "lastSeen": "last_seen",
    "estArrivalAirport": "arrival_airport",
    "callsign": "callsign",
    "estDepartureAirportHorizDistance": "departure_airport_horiz_distance",
    "estDepartureAirportVertDistance": "departure_airport_vert_distance",
    "estArrivalAirportHorizDistance": "arrival_airport_horiz_distance",
    "estArrivalAirportVertDistance": "arrival_airport_vert_distance",
    "departureAirportCandidatesCount": "departure_airport_candidates",
    "arrivalAirportCandidatesCount": "arrival_airport_candidates",
}

BRONZE_COLUMNS = list(PAYLOAD_TO_BRONZE.values())

# Batches keep the names of the CSV files they first were, however they are stored.
BATCH_SUFFIX = ".csv"

# Header line, and quotes inside quoted text doubled.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}

CODE_COLUMNS = ["icao24", "callsign", "departure_airport", "arrival_airport"]
EPOCH_COLUMNS = ["first_seen", "last_seen"]
DISTANCE_COLUMNS = [c for c in BRONZE_COLUMNS if c.endswith("_distance")]
CANDIDATE_COLUMNS = [c for c in BRONZE_COLUMNS if c.endswith("_candidates")]
NUMERIC_COLUMNS = EPOCH_COLUMNS + DISTANCE_COLUMNS + CANDIDATE_COLUMNS

# One flight record: same aircraft, same first and last sighting.
FLIGHT_GRAIN = ["icao24", "first_seen", "last_seen"]


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Text throughout, so ids such as 004012 and malformed numbers reach silver untouched.
PAYLOAD_SCHEMA = _strings(PAYLOAD_TO_BRONZE)
BRONZE_SCHEMA = _strings(BRONZE_COLUMNS)
LANDED_SCHEMA = T.StructType(
    [
        *BRONZE_SCHEMA.fields,
        T.StructField(
            "row_order",
            T.StructType(
                [
                    T.StructField("part", T.StringType()),
                    T.StructField("block", T.LongType()),
                    T.StructField("id", T.LongType()),
                ]
            ),
        ),
        T.StructField("bronze_file", T.StringType()),
    ]
)

AIRPORT_COLUMNS = ["ident", "name", "iso_country", "icao_code", "iata_code"]

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("departure_airport", T.StringType()),
        T.StructField("arrival_airport", T.StringType()),
        T.StructField("departure_time", T.TimestampType()),
        T.StructField("arrival_time", T.TimestampType()),
        T.StructField("flight_duration_minutes", T.DoubleType()),
        T.StructField("route", T.StringType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField("departure_hour", T.IntegerType()),
        T.StructField("bronze_file", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
SILVER_COLUMNS = SILVER_SCHEMA.names

LOOKUP_COLUMNS = ["airport_code", "airport_iata", "airport_name", "country_code"]

ENRICHED_SCHEMA = T.StructType(
    SILVER_SCHEMA.fields
    + _strings(
        [
            "departure_iata",
            "departure_airport_name",
            "departure_country",
            "arrival_iata",
            "arrival_airport_name",
            "arrival_country",
        ]
    ).fields
)
ENRICHED_COLUMNS = ENRICHED_SCHEMA.names

TRAFFIC_METRICS = [
    "departures",
    "departure_aircraft",
    "arrivals",
    "arrival_aircraft",
    "total_traffic",
    "unique_aircraft",
]


def _gold(dimensions, metrics) -> T.StructType:
    return T.StructType(
        [T.StructField("flight_date", T.DateType())]
        + [T.StructField(d, T.StringType()) for d in dimensions]
        + [T.StructField(m, T.LongType()) for m in metrics]
    )


AIRPORT_TRAFFIC_SCHEMA = _gold(["airport", "country"], TRAFFIC_METRICS)
COUNTRY_TRAFFIC_SCHEMA = _gold(["country"], TRAFFIC_METRICS)
ROUTE_TRAFFIC_SCHEMA = _gold(
    ["departure_airport", "arrival_airport", "route"], ["flight_count", "unique_aircraft"]
)


class GoldTable:
    """Schema, unique key and ranking metric of one gold table."""

    def __init__(self, name: str, schema: T.StructType, key: list[str], metric: str):
        self.name = name
        self.schema = schema
        self.key = key
        self.metric = metric


AIRPORT_TRAFFIC = GoldTable(
    "airport_traffic", AIRPORT_TRAFFIC_SCHEMA, ["flight_date", "airport"], "total_traffic"
)
COUNTRY_TRAFFIC = GoldTable(
    "country_traffic", COUNTRY_TRAFFIC_SCHEMA, ["flight_date", "country"], "total_traffic"
)
ROUTE_TRAFFIC = GoldTable(
    "route_traffic",
    ROUTE_TRAFFIC_SCHEMA,
    ["flight_date", "departure_airport", "arrival_airport"],
    "flight_count",
)
GOLD_TABLES = [AIRPORT_TRAFFIC, COUNTRY_TRAFFIC, ROUTE_TRAFFIC]
