"""Dashboard measures over gold and enriched tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.functions.numeric import count_or_zero
from flightlake.operators.history import ranking_order
from flightlake.operators.traffic import (
    aircraft_activity,
    airport_activity,
    all_known,
    movements,
)
from flightlake.schemas import GoldTable
from flightlake.session import parse_day


def top_k(gold: DataFrame, table: GoldTable, k: int = 10) -> DataFrame:
    """The k busiest rows, ties by date and key."""
    order = ranking_order(table)
    return gold.orderBy(order[0], F.asc("flight_date"), *order[1:]).limit(k)


def top_k_per_day(gold: DataFrame, table: GoldTable, k: int = 10) -> DataFrame:
    """The k busiest rows of every date; Spark cuts each task to k per date before shuffling."""
    rank = F.row_number().over(Window.partitionBy("flight_date").orderBy(*ranking_order(table)))
    return gold.withColumn("position", rank).where(F.col("position") <= k)


def rank_per_day(gold: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Competition ranks within each date, one per metric -> rank column. A date of a gold
    table holds at most one row per airport or country, which bounds the window."""
    return gold.withColumns(
        {
            name: F.rank().over(Window.partitionBy("flight_date").orderBy(F.desc(metric)))
            for metric, name in metrics.items()
        }
    )


def slice_rows(
    df: DataFrame,
    first_date: str | dt.date | None = None,
    last_date: str | dt.date | None = None,
    **values: str | Sequence[str],
) -> DataFrame:
    """Slicers: a date range and any number of `column=value` or `column=[values]`."""
    if first_date is not None:
        df = df.where(F.col("flight_date") >= F.lit(parse_day(first_date)))
    if last_date is not None:
        df = df.where(F.col("flight_date") <= F.lit(parse_day(last_date)))
    for column, wanted in values.items():
        wanted = [wanted] if isinstance(wanted, str) else list(wanted)
        df = df.where(F.col(column).isin(wanted))
    return df


def kpi_global(airports: DataFrame, routes: DataFrame) -> DataFrame:
    """Traffic, countries, airports and routes per date. Every country row of a date stems
    from an airport row, so two of the gold tables are enough."""
    by_country = airports.groupBy("flight_date", "country").agg(
        F.sum("total_traffic").alias("traffic"), F.count("*").alias("airports")
    )
    zero = F.lit(0).cast("long")
    parts = by_country.select(
        "flight_date", "traffic", "airports", F.lit(1).cast("long").alias("countries"), zero.alias("routes")
    ).unionByName(
        routes.groupBy("flight_date")
        .agg(F.count("*").alias("routes"))
        .select(
            "flight_date",
            zero.alias("traffic"),
            zero.alias("airports"),
            zero.alias("countries"),
            "routes",
        )
    )
    return parts.groupBy("flight_date").agg(
        F.sum("traffic").alias("total_traffic"),
        F.sum("countries").alias("countries"),
        F.sum("airports").alias("airports"),
        F.sum("routes").alias("routes"),
    )


def kpi_airport(enriched: DataFrame) -> DataFrame:
    """Traffic, departures, arrivals and distinct aircraft over all airports and dates.
    Daily distinct counts do not add up, so aircraft are counted on the flights."""
    moves = movements(enriched).where(all_known(["flight_date", "airport", "country"]))
    per_aircraft = aircraft_activity(moves, []).where(F.col("icao24").isNotNull())
    return per_aircraft.agg(
        count_or_zero(F.sum("n_departures")).alias("departures"),
        count_or_zero(F.sum("n_arrivals")).alias("arrivals"),
        F.count("*").alias("aircraft"),
    ).withColumn("total_traffic", F.col("departures") + F.col("arrivals"))


def kpi_country(enriched: DataFrame) -> DataFrame:
    """Traffic, distinct aircraft and distinct airports per country over all dates.

    Flights are folded to (country, airport, aircraft) first. That set is folded again by
    aircraft and by airport, so each distinct count is a plain count of a group's rows.
    """
    moves = movements(enriched).where(F.col("flight_date").isNotNull())
    activity = aircraft_activity(moves, ["country", "airport"])
    moved = F.when(F.col("icao24").isNotNull(), F.col("n_departures") + F.col("n_arrivals"))
    by_aircraft = activity.groupBy("country", "icao24").agg(F.sum(moved).alias("moves"))
    countries = by_aircraft.groupBy("country").agg(
        count_or_zero(F.sum("moves")).alias("total_traffic"), F.count("icao24").alias("aircraft")
    )
    airports = activity.select("country", "airport").distinct()
    airports = airports.groupBy("country").agg(F.count("airport").alias("airports"))
    return countries.join(airports, "country")


def kpi_route(enriched: DataFrame) -> DataFrame:
    """Flights, distinct aircraft and observed routes over all dates: one fold by route, one by
    aircraft, each counted as it is."""
    flights = enriched.where(all_known(["flight_date", "departure_airport", "arrival_airport"]))
    routes = flights.groupBy("route").agg(F.count("icao24").alias("n"))
    aircraft = flights.select("icao24").distinct().agg(F.count("icao24"))
    return routes.agg(
        count_or_zero(F.sum("n")).alias("flights"), F.count("route").alias("routes")
    ).select("flights", aircraft.scalar().alias("aircraft"), "routes")


def arrivals_vs_departures(gold: DataFrame, dimension: str) -> DataFrame:
    totals = gold.groupBy(dimension).agg(
        F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures")
    )
    return totals.withColumns(
        {
            "difference": F.col("arrivals") - F.col("departures"),
            "ratio": F.try_divide(F.col("arrivals").cast("double"), F.col("departures").cast("double")),
        }
    )


def trend(gold: DataFrame, table: GoldTable) -> DataFrame:
    """Activity over time with the change since the entity's previous active date. A window
    holds one entity's dates, at most one row per day of history."""
    entity = [k for k in table.key if k != "flight_date"]
    previous = F.lag(table.metric).over(Window.partitionBy(*entity).orderBy("flight_date"))
    return gold.select(
        "flight_date",
        *entity,
        table.metric,
        "unique_aircraft",
        (F.col(table.metric) - previous).alias("change"),
    )


def calendar_trend(gold: DataFrame, table: GoldTable, days: int = 7) -> DataFrame:
    """Activity on every calendar day from an entity's first to its last active date.

    Days without activity are zero rows. The change is that from the day before, and the moving
    sum goes over the last `days` calendar days. A date's gap is filled from the date itself up to
    the next active one, so the calendar needs no join: one shuffle, by entity, as in `trend`.
    """
    entity = [k for k in table.key if k != "flight_date"]
    dated = Window.partitionBy(*entity).orderBy("flight_date")
    following = F.lead("flight_date").over(dated)
    until = F.coalesce(F.date_sub(following, 1), F.col("flight_date"))
    filled = (
        gold.select("flight_date", *entity, table.metric, "unique_aircraft", until.alias("until"))
        .withColumn("day", F.explode(F.sequence("flight_date", "until")))
        .withColumn("active", F.col("day") == F.col("flight_date"))
    )
    daily = filled.select(
        F.col("day").alias("flight_date"),
        *entity,
        *[
            F.when(F.col("active"), F.col(c)).otherwise(F.lit(0)).alias(c)
            for c in (table.metric, "unique_aircraft")
        ],
    )
    recent = (
        Window.partitionBy(*entity).orderBy(F.unix_date("flight_date")).rangeBetween(1 - days, 0)
    )
    return daily.withColumns(
        {
            "change": F.col(table.metric) - F.lag(table.metric).over(dated),
            "moving_sum": F.sum(table.metric).over(recent),
        }
    )


CUBE = ["flight_date", "country", "airport"]
# The levels a dashboard shows: any choice of date, country and airport, an airport implying its
# country.
CUBE_LEVELS = [CUBE, CUBE[:2], CUBE[:1], CUBE[1:], CUBE[1:2], []]


def _first_rows() -> dict[str, Column]:
    """For each level of the cube, whether a row of activity is its aircraft's first one in its group.

    Rows of an aircraft are sorted by place and by date; in either order the groups of some levels
    lie together, so a row starts one if it differs from the row before. Unknown aircraft count
    nothing; their rows are spread by a hash.
    """
    apart = F.when(F.col("icao24").isNull(), F.xxhash64(*CUBE))
    by_place = Window.partitionBy("icao24", apart).orderBy(*CUBE[1:])
    by_date = Window.partitionBy("icao24", apart).orderBy(*CUBE[:2])

    def starts(level: list[str], order) -> Column:
        same = F.lag(F.lit(True), 1, False).over(order)
        for column in level:
            same = same & F.lag(column).over(order).eqNullSafe(F.col(column))
        return ~same

    found = [
        F.lit(True) if level == CUBE else starts(level, by_date if CUBE[0] in level else by_place)
        for level in CUBE_LEVELS
    ]
    return {f"first_{i}": first for i, first in enumerate(found)}


def kpi_cube(enriched: DataFrame) -> DataFrame:
    """Departures, arrivals, traffic and distinct aircraft at every level of the slicers, in one
    pass over the flights.

    `level` has a bit set for each of date (4), country (2) and airport (1) that is summed over.
    Flights are folded to a row per aircraft, airport and date first. Each of these rows is marked
    where it is its aircraft's first one in a level's group, so distinct counts are counts of marks,
    which add up: rows are folded to one per airport and date before they are copied to the levels.
    Unknown aircraft keep their group and count nothing.
    """
    activity = airport_activity(enriched)
    known = F.col("icao24").isNotNull()
    marks = _first_rows()
    by_airport = (
        activity.withColumns(marks)
        .groupBy(*CUBE)
        .agg(
            F.sum(F.when(known, F.col("n_departures"))).alias("departures"),
            F.sum(F.when(known, F.col("n_arrivals"))).alias("arrivals"),
            *[F.count_if(known & F.col(mark)).alias(mark) for mark in marks],
        )
    )
    sets = [[F.col(c) for c in level] for level in CUBE_LEVELS]
    aircraft = F.lit(0)
    for mark, level in zip(marks, CUBE_LEVELS, strict=True):
        bits = sum(1 << i for i, c in enumerate(reversed(CUBE)) if c not in level)
        aircraft = F.when(F.grouping_id() == bits, F.sum(mark)).otherwise(aircraft)
    return (
        by_airport.groupingSets(sets, *CUBE)
        .agg(
            F.grouping_id().alias("level"),
            count_or_zero(F.sum("departures")).alias("departures"),
            count_or_zero(F.sum("arrivals")).alias("arrivals"),
            count_or_zero(aircraft).alias("aircraft"),
        )
        .select("level", *CUBE, "departures", "arrivals", "aircraft")
        .withColumn("total_traffic", F.col("departures") + F.col("arrivals"))
    )


def routes_between_top_airports(airports: DataFrame, routes: DataFrame, k: int = 10) -> DataFrame:
    """Routes whose two ends are both among the k busiest airports, over all dates."""
    busiest = (
        airports.groupBy("airport")
        .agg(F.sum("total_traffic").alias("traffic"))
        .orderBy(F.desc("traffic"), F.asc("airport"))
        .limit(k)
    )
    # k rows, so broadcasting them is bounded by construction.
    ends = ["departure_airport", "arrival_airport"]
    for end in ends:
        routes = routes.join(
            F.broadcast(busiest.select(F.col("airport").alias(end))), end, "left_semi"
        )
    return routes.groupBy(*ends, "route").agg(F.sum("flight_count").alias("flight_count"))
