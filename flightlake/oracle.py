"""Oracle SQL for the registered queries.

Written from the table definitions, not from the Spark code: gold tables are built here by
aggregating each role alone, outer-joining the roles and joining distinct counts of their
union, while Spark counts movements in two steps.
"""

from __future__ import annotations

# One common table expression per layer; a statement takes the ones it needs, in this order.
LAYERS: dict[str, str] = {}

LAYERS["bronze"] = """
SELECT
    concat(' ac', lpad(CAST(l_suppkey AS VARCHAR), 6, '0'), ' ') AS icao24,
    CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400
         + l_linenumber * 5400 AS VARCHAR) AS first_seen,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '  '
         ELSE lower(sn.n_name) END AS departure_airport,
    CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 86400
         + l_linenumber * 7200 AS VARCHAR) AS last_seen,
    CASE WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN NULL
         ELSE concat(' ', cn.n_name) END AS arrival_airport,
    CASE WHEN l_linenumber = 7 THEN ''
         ELSE concat('cs', CAST(o_orderkey AS VARCHAR), batch) END AS callsign,
    CASE WHEN l_linenumber = 4 AND l_quantity > 45 THEN 'bad'
         ELSE CAST(CAST(l_quantity AS INTEGER) - 5 AS VARCHAR)
         END AS departure_airport_horiz_distance,
    CASE WHEN l_linenumber = 5 AND l_quantity > 45 THEN '1d'
         ELSE CAST(CAST(l_quantity AS INTEGER) - 10 AS VARCHAR)
         END AS departure_airport_vert_distance,
    CASE WHEN l_linenumber = 6 AND l_quantity > 45 THEN 'NaN'
         ELSE CAST(CAST(l_quantity AS INTEGER) - 3 AS VARCHAR)
         END AS arrival_airport_horiz_distance,
    CASE WHEN l_linenumber = 2 AND l_quantity > 45 THEN 'inf'
         ELSE concat(' ', CAST(CAST(l_quantity AS INTEGER) - 20 AS VARCHAR), '.5')
         END AS arrival_airport_vert_distance,
    CAST(l_linenumber AS VARCHAR) AS departure_airport_candidates,
    CASE WHEN l_linenumber <> 1 THEN CAST(l_linenumber % 3 AS VARCHAR)
         END AS arrival_airport_candidates,
    batch AS bronze_file, o_orderkey, l_linenumber, l_partkey
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN (VALUES ('a'), ('b')) AS deliveries(batch) ON batch = 'a' OR l_linenumber = 3
"""


def _number(column: str) -> str:
    text = f"trim({column})"
    return (
        f"CASE WHEN isfinite(TRY_CAST({text} AS DOUBLE))"
        f" THEN TRY_CAST({text} AS DOUBLE) END AS {column}"
    )


def _code(column: str) -> str:
    return f"nullif(upper(trim({column})), '') AS {column}"


_CODES = ["icao24", "callsign", "departure_airport", "arrival_airport"]
_DISTANCES = [
    "departure_airport_horiz_distance",
    "departure_airport_vert_distance",
    "arrival_airport_horiz_distance",
    "arrival_airport_vert_distance",
]
_NUMBERS = [
    "first_seen",
    "last_seen",
    *_DISTANCES,
    "departure_airport_candidates",
    "arrival_airport_candidates",
]
_BRONZE = [
    "icao24",
    "first_seen",
    "departure_airport",
    "last_seen",
    "arrival_airport",
    "callsign",
    *_DISTANCES,
    "departure_airport_candidates",
    "arrival_airport_candidates",
]
_SILVER = (
    "icao24, callsign, departure_airport, arrival_airport, departure_time, arrival_time, "
    "flight_duration_minutes, route, flight_date, departure_hour, bronze_file"
)
_DEPARTURE = "departure_iata, departure_airport_name, departure_country"
_ARRIVAL = "arrival_iata, arrival_airport_name, arrival_country"

LAYERS["typed"] = f"""
SELECT {', '.join(_code(c) for c in _CODES)}, {', '.join(_number(c) for c in _NUMBERS)},
       bronze_file, o_orderkey, l_linenumber, l_partkey
FROM bronze
"""

LAYERS["timed"] = """
SELECT *,
    CASE WHEN abs(first_seen) <= 9223372036
         THEN make_timestamp(CAST(first_seen * 1000000 AS BIGINT)) END AS raw_departure,
    CASE WHEN abs(last_seen) <= 9223372036
         THEN make_timestamp(CAST(last_seen * 1000000 AS BIGINT)) END AS raw_arrival
FROM typed
"""

LAYERS["valid"] = """
SELECT *,
    CASE WHEN raw_arrival < raw_departure THEN NULL ELSE raw_departure END AS departure_time,
    CASE WHEN raw_arrival < raw_departure THEN NULL ELSE raw_arrival END AS arrival_time
FROM timed
"""

LAYERS["featured"] = """
SELECT *,
    CASE WHEN arrival_time >= departure_time
         THEN (epoch_us(arrival_time) - epoch_us(departure_time)) / 60000000.0::DOUBLE
         END AS flight_duration_minutes,
    departure_airport || ' -> ' || arrival_airport AS route,
    CAST(departure_time AS DATE) AS flight_date,
    CAST(extract('hour' FROM departure_time) AS INTEGER) AS departure_hour
FROM valid
"""

LAYERS["silver"] = """
SELECT * FROM featured
QUALIFY row_number() OVER (
    PARTITION BY icao24, first_seen, last_seen
    ORDER BY bronze_file, o_orderkey, l_linenumber, l_partkey) = 1
"""

LAYERS["airports"] = """
SELECT n_name || ' Airport' || CASE WHEN k = 1 THEN ' copy' ELSE '' END AS name,
       upper(r_name) AS iso_country,
       CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE upper(n_name) END AS icao_code,
       concat('N', CAST(n_nationkey AS VARCHAR)) AS iata_code,
       n_nationkey * 10 + k AS position
FROM nation
JOIN region ON n_regionkey = r_regionkey
JOIN (VALUES (0), (1)) AS copies(k) ON k = 0 OR n_nationkey = 1
"""

LAYERS["lookup"] = """
SELECT icao_code AS airport_code, iata_code AS airport_iata, name AS airport_name,
       iso_country AS country_code
FROM airports WHERE icao_code IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY icao_code ORDER BY position) = 1
"""

LAYERS["enriched"] = """
SELECT silver.*,
       d.airport_iata AS departure_iata, d.airport_name AS departure_airport_name,
       d.country_code AS departure_country,
       a.airport_iata AS arrival_iata, a.airport_name AS arrival_airport_name,
       a.country_code AS arrival_country
FROM silver
LEFT JOIN lookup d ON silver.departure_airport = d.airport_code
LEFT JOIN lookup a ON silver.arrival_airport = a.airport_code
"""

LAYERS["airport_dep"] = """
SELECT flight_date, departure_airport AS airport, departure_country AS country,
       count(icao24) AS departures, count(DISTINCT icao24) AS departure_aircraft
FROM enriched
WHERE flight_date IS NOT NULL AND departure_airport IS NOT NULL
  AND departure_country IS NOT NULL
GROUP BY ALL
"""

LAYERS["airport_arr"] = """
SELECT flight_date, arrival_airport AS airport, arrival_country AS country,
       count(icao24) AS arrivals, count(DISTINCT icao24) AS arrival_aircraft
FROM enriched
WHERE flight_date IS NOT NULL AND arrival_airport IS NOT NULL AND arrival_country IS NOT NULL
GROUP BY ALL
"""

LAYERS["airport_merged"] = """
SELECT flight_date, airport, country,
       coalesce(departures, 0) AS departures,
       coalesce(departure_aircraft, 0) AS departure_aircraft,
       coalesce(arrivals, 0) AS arrivals,
       coalesce(arrival_aircraft, 0) AS arrival_aircraft,
       coalesce(departures, 0) + coalesce(arrivals, 0) AS total_traffic
FROM airport_dep FULL OUTER JOIN airport_arr USING (flight_date, airport, country)
"""

LAYERS["airport_unique"] = """
SELECT flight_date, airport, count(DISTINCT icao24) AS unique_aircraft
FROM (SELECT flight_date, departure_airport AS airport, icao24 FROM enriched
      UNION ALL
      SELECT flight_date, arrival_airport, icao24 FROM enriched)
WHERE flight_date IS NOT NULL AND airport IS NOT NULL
GROUP BY ALL
"""

LAYERS["airport_gold"] = """
SELECT airport_merged.*, coalesce(unique_aircraft, 0) AS unique_aircraft
FROM airport_merged LEFT JOIN airport_unique USING (flight_date, airport)
"""

LAYERS["country_dep"] = """
SELECT flight_date, departure_country AS country,
       count(icao24) AS departures, count(DISTINCT icao24) AS departure_aircraft
FROM enriched WHERE flight_date IS NOT NULL AND departure_country IS NOT NULL
GROUP BY ALL
"""

LAYERS["country_arr"] = """
SELECT flight_date, arrival_country AS country,
       count(icao24) AS arrivals, count(DISTINCT icao24) AS arrival_aircraft
FROM enriched WHERE flight_date IS NOT NULL AND arrival_country IS NOT NULL
GROUP BY ALL
"""

LAYERS["country_merged"] = """
SELECT flight_date, country,
       coalesce(departures, 0) AS departures,
       coalesce(departure_aircraft, 0) AS departure_aircraft,
       coalesce(arrivals, 0) AS arrivals,
       coalesce(arrival_aircraft, 0) AS arrival_aircraft,
       coalesce(departures, 0) + coalesce(arrivals, 0) AS total_traffic
FROM country_dep FULL OUTER JOIN country_arr USING (flight_date, country)
"""

LAYERS["country_unique"] = """
SELECT flight_date, country, count(DISTINCT icao24) AS unique_aircraft
FROM (SELECT flight_date, departure_country AS country, icao24 FROM enriched
      UNION ALL
      SELECT flight_date, arrival_country, icao24 FROM enriched)
WHERE flight_date IS NOT NULL AND country IS NOT NULL
GROUP BY ALL
"""

LAYERS["country_gold"] = """
SELECT country_merged.*, coalesce(unique_aircraft, 0) AS unique_aircraft
FROM country_merged LEFT JOIN country_unique USING (flight_date, country)
"""

LAYERS["route_gold"] = """
SELECT counted.*, coalesce(unique_aircraft, 0) AS unique_aircraft
FROM (SELECT flight_date, departure_airport, arrival_airport, route,
             count(icao24) AS flight_count
      FROM enriched
      WHERE flight_date IS NOT NULL AND departure_airport IS NOT NULL
        AND arrival_airport IS NOT NULL
      GROUP BY ALL) counted
LEFT JOIN (SELECT flight_date, departure_airport, arrival_airport,
                  count(DISTINCT icao24) AS unique_aircraft
           FROM enriched GROUP BY ALL) aircraft
USING (flight_date, departure_airport, arrival_airport)
"""

LAYERS["moves"] = """
SELECT flight_date, departure_airport AS airport, departure_country AS country, icao24,
       1 AS dep, 0 AS arr
FROM enriched WHERE flight_date IS NOT NULL AND departure_country IS NOT NULL
UNION ALL
SELECT flight_date, arrival_airport, arrival_country, icao24, 0, 1
FROM enriched WHERE flight_date IS NOT NULL AND arrival_country IS NOT NULL
"""

LAYERS["planned"] = """
SELECT CAST(day AS DATE) AS day, n + 1 AS window_number,
       day + n * INTERVAL 2 HOUR AS window_start,
       day + (n + 1) * INTERVAL 2 HOUR AS window_end
FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events),
     generate_series(0, 11) AS series(n)
"""

LAYERS["departure_plan"] = """
SELECT CAST(day AS DATE) AS day, n + 1 AS window_number,
       day + n * INTERVAL 2 HOUR AS window_start,
       day + (n + 1) * INTERVAL 2 HOUR AS window_end
FROM (SELECT DISTINCT CAST(CAST(departure_time AS DATE) AS TIMESTAMP) AS day
      FROM silver WHERE departure_time IS NOT NULL),
     generate_series(0, 11) AS series(n)
"""

# Which layers a layer is built on.
_BASE = {
    "typed": ["bronze"],
    "timed": ["typed"],
    "valid": ["timed"],
    "featured": ["valid"],
    "silver": ["featured"],
    "lookup": ["airports"],
    "enriched": ["silver", "lookup"],
    "airport_dep": ["enriched"],
    "airport_arr": ["enriched"],
    "airport_merged": ["airport_dep", "airport_arr"],
    "airport_unique": ["enriched"],
    "airport_gold": ["airport_merged", "airport_unique"],
    "country_dep": ["enriched"],
    "country_arr": ["enriched"],
    "country_merged": ["country_dep", "country_arr"],
    "country_unique": ["enriched"],
    "country_gold": ["country_merged", "country_unique"],
    "route_gold": ["enriched"],
    "moves": ["enriched"],
    "departure_plan": ["silver"],
}

_LABEL = (
    "concat('flights_', strftime(window_start, '%Y-%m-%d_%H-%M'), '_to_', "
    "strftime(window_end, '%H-%M'), '.csv')"
)
_RUN_DATE = "DATE '1995-07-12'"


def _replaced(gold: str, metric: str) -> str:
    """Other dates keep what an earlier run left, which is one more."""
    return f"""SELECT * REPLACE (CASE WHEN flight_date = {_RUN_DATE} THEN {metric} ELSE {metric} + 1
                      END AS {metric}) FROM {gold}"""


def _upserted(gold: str, metric: str) -> str:
    """On the run date the batch wins; keys it lacks keep a value 1000 higher, if they were in
    the target at all."""
    return f"""SELECT * REPLACE (CASE WHEN flight_date <> {_RUN_DATE} THEN {metric} + 1
                           WHEN {metric} % 3 <> 0 THEN {metric} ELSE {metric} + 1000
                      END AS {metric})
               FROM {gold}
               WHERE flight_date <> {_RUN_DATE} OR {metric} % 3 <> 0 OR unique_aircraft <= 1"""



_TOP10 = "ORDER BY {metric} DESC, flight_date, {key} LIMIT 10"


def _daily_top(table: str, metric: str, key: str) -> str:
    return (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY flight_date ORDER BY {metric} DESC,"
        f" {key}) AS INTEGER) AS position FROM {table} QUALIFY position <= 10"
    )


def _ranked(table: str) -> str:
    ranks = ", ".join(
        f"CAST(rank() OVER (PARTITION BY flight_date ORDER BY {metric} DESC) AS INTEGER) AS {name}"
        for metric, name in (("total_traffic", "traffic_rank"), ("unique_aircraft", "aircraft_rank"))
    )
    return f"SELECT *, {ranks} FROM {table}"


def _trend(table: str, metric: str, entity: str) -> str:
    return (
        f"SELECT flight_date, {entity}, {metric}, unique_aircraft, {metric} - lag({metric})"
        f" OVER (PARTITION BY {entity} ORDER BY flight_date) AS change FROM {table}"
    )


def _calendar(table: str, metric: str, entity: str) -> str:
    """Every day between an entity's first and last one, joined with its activity."""
    entities = entity.split(", ")
    on = " AND ".join(f"s.{e} = g.{e}" for e in entities)
    return f"""
    SELECT CAST(day AS DATE) AS flight_date, {', '.join(f's.{e} AS {e}' for e in entities)},
           coalesce({metric}, 0) AS {metric}, coalesce(unique_aircraft, 0) AS unique_aircraft,
           coalesce({metric}, 0) - lag(coalesce({metric}, 0)) OVER dated AS change,
           CAST(sum(coalesce({metric}, 0)) OVER (dated RANGE BETWEEN INTERVAL 6 DAYS PRECEDING
                                                 AND CURRENT ROW) AS BIGINT) AS moving_sum
    FROM (SELECT {entity}, unnest(generate_series(min(flight_date)::TIMESTAMP,
                 max(flight_date)::TIMESTAMP, INTERVAL 1 DAY)) AS day
          FROM {table} GROUP BY {entity}) s
    LEFT JOIN {table} g ON {on} AND g.flight_date = CAST(s.day AS DATE)
    WINDOW dated AS (PARTITION BY {', '.join(f's.{e}' for e in entities)} ORDER BY day)"""


# Query -> (layers it reads, final select).
FINAL: dict[str, tuple[list[str], str]] = {
    "bronze_project": (["bronze"], f"SELECT {', '.join(_BRONZE)} FROM bronze"),
    "bronze_label": (
        [],
        f"""SELECT CAST(window_start AS DATE) AS ingest_date, window_start, window_end,
                   {_LABEL} AS bronze_file, count(*) AS row_count
            FROM (SELECT time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '2000-01-01') AS window_start,
                         window_start + INTERVAL 2 HOUR AS window_end FROM events)
            GROUP BY ALL""",
    ),
    "bronze_scan": (["bronze"], f"SELECT {', '.join(_BRONZE)} FROM bronze"),
    "bronze_lineage": (
        ["bronze"],
        "SELECT icao24, first_seen, last_seen, callsign, bronze_file FROM bronze",
    ),
    "bronze_union_by_name": (
        ["bronze"],
        "SELECT * REPLACE ("
        + ", ".join(
            f"CASE WHEN bronze_file = 'a' THEN {c} END AS {c}" for c in _BRONZE if c.endswith("_distance")
        )
        + f") FROM (SELECT {', '.join(_BRONZE)}, bronze_file FROM bronze)",
    ),
    "bronze_batch_counts": (
        ["bronze"],
        "SELECT bronze_file, count(*) AS row_count FROM bronze GROUP BY bronze_file",
    ),
    "bronze_batch_totals": (
        ["bronze"],
        "SELECT count(DISTINCT bronze_file) AS total_files, count(*) AS total_rows FROM bronze",
    ),
    "normalize_headers": (["bronze"], f"SELECT {', '.join(_BRONZE)} FROM bronze"),
    "window_last_hour": (
        [],
        """SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR AS window_start,
                  date_trunc('hour', ts) AS window_end, count(*) AS runs
           FROM events GROUP BY ALL""",
    ),
    "window_day": (
        [],
        """SELECT CAST(ts AS DATE) AS day, count(*) AS runs,
                  date_trunc('day', ts)::TIMESTAMP AS day_start,
                  date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS day_end,
                  date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY AS previous_start,
                  date_trunc('day', ts)::TIMESTAMP AS previous_end
           FROM events GROUP BY ALL""",
    ),
    "window_backfill_plan": (
        ["planned"],
        f"""SELECT day, CAST(window_number AS INTEGER) AS window_number, window_start,
                   window_end, {_LABEL} AS bronze_file FROM planned""",
    ),
    "backfill_coverage": (
        ["departure_plan"],
        f"""SELECT day, CAST(window_number AS INTEGER) AS window_number, window_start,
                   window_end, {_LABEL} AS bronze_file, count(departure_time) AS row_count
            FROM departure_plan
            LEFT JOIN silver ON time_bucket(INTERVAL 2 HOUR, departure_time, TIMESTAMP '2000-01-01')
                               = window_start
            GROUP BY ALL""",
    ),
    "clean_strings": (
        ["bronze"],
        f"SELECT {', '.join(_code(c) for c in _CODES)}, first_seen, last_seen, bronze_file"
        " FROM bronze",
    ),
    "blank_to_null": (
        ["bronze"],
        "SELECT "
        + ", ".join(f"CASE WHEN trim({c}) <> '' THEN {c} END AS {c}" for c in _BRONZE)
        + ", bronze_file FROM bronze",
    ),
    "to_numeric_coerce": (
        ["bronze"],
        f"SELECT icao24, callsign, {', '.join(_number(c) for c in _NUMBERS)} FROM bronze",
    ),
    "nan_to_null": (
        ["bronze"],
        """SELECT icao24, first_seen, last_seen, bronze_file,
                  CASE WHEN lower(arrival_airport_horiz_distance) <> 'nan'
                       THEN CAST(arrival_airport_horiz_distance AS DOUBLE) END AS distance
           FROM bronze""",
    ),
    "epoch_to_timestamp": (
        ["bronze", "timed"],
        """SELECT bronze.icao24 AS icao24, timed.bronze_file AS bronze_file,
                  timed.first_seen AS first_seen, timed.last_seen AS last_seen,
                  raw_departure AS departure_time, raw_arrival AS arrival_time
           FROM timed JOIN (SELECT DISTINCT icao24 FROM bronze) bronze
             ON upper(trim(bronze.icao24)) = timed.icao24""",
    ),
    "validate_time_order": (
        ["bronze", "valid"],
        """SELECT bronze.icao24 AS icao24, valid.bronze_file AS bronze_file,
                  valid.first_seen AS first_seen, valid.last_seen AS last_seen,
                  departure_time, arrival_time
           FROM valid JOIN (SELECT DISTINCT icao24 FROM bronze) bronze
             ON upper(trim(bronze.icao24)) = valid.icao24""",
    ),
    "validate_non_negative": (
        ["bronze", "typed"],
        "SELECT bronze.icao24 AS icao24, first_seen, last_seen, "
        + ", ".join(f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" for c in _DISTANCES)
        + """ FROM typed JOIN (SELECT DISTINCT icao24 FROM bronze) bronze
              ON upper(trim(bronze.icao24)) = typed.icao24""",
    ),
    "dedup_first": (
        ["silver"],
        "SELECT icao24, first_seen, last_seen, callsign, departure_airport, arrival_airport,"
        " bronze_file FROM silver",
    ),
    "flight_duration": (
        ["featured"],
        "SELECT icao24, departure_time, arrival_time, flight_duration_minutes FROM featured",
    ),
    "route_key": (
        ["featured"],
        "SELECT icao24, first_seen, departure_airport, arrival_airport, route FROM featured",
    ),
    "time_features": (
        ["featured"],
        "SELECT icao24, first_seen, departure_time, flight_date, departure_hour FROM featured",
    ),
    "silver_flights": (["silver"], f"SELECT {_SILVER} FROM silver"),
    "silver_quality": (
        ["silver"],
        """SELECT (SELECT count(*) FROM bronze) - count(*) AS duplicates_removed,
                  count(*) AS rows_after, count(departure_airport) AS rows_with_departure,
                  count(arrival_airport) AS rows_with_arrival, count(route) AS rows_with_route
           FROM silver""",
    ),
    "airport_lookup": (["lookup"], "SELECT * FROM lookup"),
    "enrich_departure": (["enriched"], f"SELECT {_SILVER}, {_DEPARTURE} FROM enriched"),
    "enrich_arrival": (["enriched"], f"SELECT {_SILVER}, {_ARRIVAL} FROM enriched"),
    "enriched_flights": (
        ["enriched"],
        f"SELECT {_SILVER}, {_DEPARTURE}, {_ARRIVAL} FROM enriched",
    ),
    "enrichment_match_stats": (
        ["enriched"],
        """SELECT count(*) AS flights, count(departure_airport_name) AS departures_matched,
                  count(arrival_airport_name) AS arrivals_matched,
                  (SELECT count(*) FROM lookup) AS lookup_rows
           FROM enriched""",
    ),
    "coerce_date": (
        [],
        """SELECT o_orderkey,
                  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS flight_date,
                  CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
                       END AS date_text
           FROM orders""",
    ),
    "filter_processing_date": (
        ["enriched"],
        f"SELECT {_SILVER}, {_DEPARTURE}, {_ARRIVAL} FROM enriched WHERE flight_date = {_RUN_DATE}",
    ),
    "enforce_schema": (["airport_gold"], "SELECT * FROM airport_gold"),
    "airport_departures": (["airport_dep"], "SELECT * FROM airport_dep"),
    "airport_arrivals": (["airport_arr"], "SELECT * FROM airport_arr"),
    "airport_outer_merge": (["airport_merged"], "SELECT * FROM airport_merged"),
    "airport_unique_aircraft": (["airport_unique"], "SELECT * FROM airport_unique"),
    "airport_traffic": (["airport_gold"], "SELECT * FROM airport_gold"),
    "country_departures": (["country_dep"], "SELECT * FROM country_dep"),
    "country_arrivals": (["country_arr"], "SELECT * FROM country_arr"),
    "country_outer_merge": (["country_merged"], "SELECT * FROM country_merged"),
    "country_unique_aircraft": (["country_unique"], "SELECT * FROM country_unique"),
    "country_traffic": (["country_gold"], "SELECT * FROM country_gold"),
    "route_traffic": (["route_gold"], "SELECT * FROM route_gold"),
    "gold_run_stats": (
        ["airport_gold", "country_gold", "route_gold"],
        f"""SELECT count(*) AS rows_before_filter,
                   count(*) FILTER (flight_date = {_RUN_DATE}) AS rows_after_filter,
                   (SELECT count(*) FROM airport_gold WHERE flight_date = {_RUN_DATE}) AS airport_rows,
                   (SELECT count(*) FROM country_gold WHERE flight_date = {_RUN_DATE}) AS country_rows,
                   (SELECT count(*) FROM route_gold WHERE flight_date = {_RUN_DATE}) AS route_rows
            FROM enriched""",
    ),
    "gold_replace_airport": (["airport_gold"], _replaced("airport_gold", "total_traffic")),
    "gold_replace_country": (["country_gold"], _replaced("country_gold", "total_traffic")),
    "gold_replace_route": (["route_gold"], _replaced("route_gold", "flight_count")),
    "gold_history_sorted": (
        ["airport_gold"],
        "SELECT * FROM airport_gold ORDER BY flight_date, total_traffic DESC, airport",
    ),
    "upsert_airport": (["airport_gold"], _upserted("airport_gold", "total_traffic")),
    "upsert_country": (["country_gold"], _upserted("country_gold", "total_traffic")),
    "upsert_route": (["route_gold"], _upserted("route_gold", "flight_count")),
    "top10_airports": (
        ["airport_gold"],
        "SELECT * FROM airport_gold " + _TOP10.format(metric="total_traffic", key="airport"),
    ),
    "top10_countries": (
        ["country_gold"],
        "SELECT * FROM country_gold " + _TOP10.format(metric="total_traffic", key="country"),
    ),
    "top10_routes": (
        ["route_gold"],
        "SELECT * FROM route_gold "
        + _TOP10.format(metric="flight_count", key="departure_airport, arrival_airport"),
    ),
    "daily_top10_airports": (
        ["airport_gold"],
        _daily_top("airport_gold", "total_traffic", "airport"),
    ),
    "daily_top10_routes": (
        ["route_gold"],
        _daily_top("route_gold", "flight_count", "departure_airport, arrival_airport"),
    ),
    "kpi_global": (
        ["airport_gold", "country_gold", "route_gold"],
        """SELECT flight_date, CAST(coalesce(traffic, 0) AS BIGINT) AS total_traffic,
                  coalesce(n_countries, 0) AS countries, coalesce(n_airports, 0) AS airports,
                  coalesce(n_routes, 0) AS routes
           FROM (SELECT flight_date, sum(total_traffic) AS traffic, count(*) AS n_airports
                 FROM airport_gold GROUP BY flight_date)
           FULL OUTER JOIN (SELECT flight_date, count(*) AS n_countries
                            FROM country_gold GROUP BY flight_date) USING (flight_date)
           FULL OUTER JOIN (SELECT flight_date, count(*) AS n_routes
                            FROM route_gold GROUP BY flight_date) USING (flight_date)""",
    ),
    "kpi_airport": (
        ["moves"],
        """SELECT CAST(sum(dep) AS BIGINT) AS departures, CAST(sum(arr) AS BIGINT) AS arrivals,
                  count(DISTINCT icao24) AS aircraft, count(*) AS total_traffic
           FROM moves WHERE icao24 IS NOT NULL""",
    ),
    "kpi_country": (
        ["moves"],
        """SELECT country, count(icao24) AS total_traffic, count(DISTINCT icao24) AS aircraft,
                  count(DISTINCT airport) AS airports
           FROM moves GROUP BY country""",
    ),
    "kpi_route": (
        ["enriched"],
        """SELECT count(icao24) AS flights, count(DISTINCT icao24) AS aircraft,
                  count(DISTINCT route) AS routes
           FROM enriched WHERE flight_date IS NOT NULL AND route IS NOT NULL""",
    ),
    "slice_gold": (
        ["airport_gold"],
        """SELECT * FROM airport_gold
           WHERE flight_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'
             AND country IN ('ASIA', 'EUROPE')""",
    ),
    "slice_routes": (
        ["route_gold"],
        """SELECT * FROM route_gold
           WHERE departure_airport = 'NATION_3' AND arrival_airport IN ('NATION_4', 'NATION_5')""",
    ),
    "rank_airports_by_aircraft": (["airport_gold"], _ranked("airport_gold")),
    "rank_countries_by_aircraft": (["country_gold"], _ranked("country_gold")),
    "arrivals_vs_departures": (
        ["country_gold"],
        """SELECT country, CAST(sum(arrivals) AS BIGINT) AS arrivals,
                  CAST(sum(departures) AS BIGINT) AS departures,
                  CAST(sum(arrivals) - sum(departures) AS BIGINT) AS difference,
                  CASE WHEN sum(departures) <> 0
                       THEN CAST(sum(arrivals) AS DOUBLE) / CAST(sum(departures) AS DOUBLE)
                       END AS ratio
           FROM country_gold GROUP BY country""",
    ),
    "trend_airport": (["airport_gold"], _trend("airport_gold", "total_traffic", "airport")),
    "trend_route": (
        ["route_gold"],
        _trend("route_gold", "flight_count", "departure_airport, arrival_airport"),
    ),
    "routes_between_top_airports": (
        ["airport_gold", "route_gold"],
        """SELECT departure_airport, arrival_airport, route,
                  CAST(sum(flight_count) AS BIGINT) AS flight_count
           FROM route_gold
           WHERE departure_airport IN (SELECT airport FROM busiest)
             AND arrival_airport IN (SELECT airport FROM busiest)
           GROUP BY ALL""",
    ),
}

FINAL |= {
    "calendar_trend_airport": (
        ["airport_gold"],
        _calendar("airport_gold", "total_traffic", "airport"),
    ),
    "calendar_trend_route": (
        ["route_gold"],
        _calendar("route_gold", "flight_count", "departure_airport, arrival_airport"),
    ),
    "kpi_cube": (
        ["moves"],
        """SELECT GROUPING(flight_date, country, airport) AS level, flight_date, country, airport,
                  CAST(coalesce(sum(dep) FILTER (icao24 IS NOT NULL), 0) AS BIGINT) AS departures,
                  CAST(coalesce(sum(arr) FILTER (icao24 IS NOT NULL), 0) AS BIGINT) AS arrivals,
                  count(DISTINCT icao24) AS aircraft, count(icao24) AS total_traffic
           FROM moves
           GROUP BY GROUPING SETS ((flight_date, country, airport), (flight_date, country),
                                   (flight_date), (country, airport), (country), ())""",
    ),
    "aircraft_by_month_airport": (
        ["enriched"],
        """SELECT CAST(date_trunc('month', flight_date) AS DATE) AS month, airport,
                  count(DISTINCT icao24) AS aircraft
           FROM (SELECT flight_date, departure_airport AS airport, icao24 FROM enriched
                 UNION ALL SELECT flight_date, arrival_airport, icao24 FROM enriched)
           WHERE flight_date IS NOT NULL AND airport IS NOT NULL AND icao24 IS NOT NULL
           GROUP BY ALL""",
    ),
    "aircraft_in_span_country": (
        ["moves"],
        """SELECT country, count(DISTINCT icao24) AS aircraft FROM moves
           WHERE flight_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'
             AND icao24 IS NOT NULL
           GROUP BY country""",
    ),
    "silver_across_deliveries": FINAL["silver_flights"],
    "late_gold_country": FINAL["country_traffic"],
    "stream_gold": FINAL["airport_traffic"],
    # The stored form ends with what the form in memory gives.
    **{
        f"stored_{name}_{table}": FINAL[f"{form}_{table}"]
        for name, form in (("replace", "gold_replace"), ("upsert", "upsert"))
        for table in ("airport", "country", "route")
    },
}

_BUSIEST = """busiest AS (SELECT airport FROM airport_gold GROUP BY airport
ORDER BY sum(total_traffic) DESC, airport LIMIT 10)"""


def _closure(layers: list[str]) -> list[str]:
    needed, queue = set(), list(layers)
    while queue:
        layer = queue.pop()
        if layer not in needed:
            needed.add(layer)
            queue.extend(_BASE.get(layer, []))
    return [layer for layer in LAYERS if layer in needed]


def statement(name: str) -> str:
    layers, select = FINAL[name]
    parts = [f"{layer} AS ({LAYERS[layer].strip()})" for layer in _closure(layers)]
    if "busiest" in select:
        parts.append(_BUSIEST)
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def statements() -> dict[str, str]:
    return {name: statement(name) for name in FINAL}
