"""Operators against pandas or plain Python on small random frames."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from flightlake.operators import enrich, measures, silver, traffic
from flightlake.schemas import (
    AIRPORT_TRAFFIC,
    BRONZE_COLUMNS,
    ENRICHED_SCHEMA,
    FLIGHT_GRAIN,
    ROUTE_TRAFFIC,
)

COUNTRY = {"AAAA": "X", "BBBB": "X", "CCCC": "Y", "DDDD": "Z", "UUUU": None, None: None}
DATES = [dt.date(2026, 9, 26), dt.date(2026, 9, 27), None]


def random_flights(seed, n=400):
    """Skewed on purpose: a third of the rows share an aircraft and an airport, and unknown
    aircraft, airports, countries and dates are common. One group has unknown aircraft only."""
    rng = random.Random(seed)
    flights = []
    for _ in range(n):
        hot = rng.random() < 0.34
        icao24 = "HOT" if hot else rng.choice(["A1", "A2", "A3", "A4", None])
        departure = "AAAA" if hot else rng.choice(["AAAA", "BBBB", "CCCC", "UUUU", None])
        arrival = rng.choice(["AAAA", "BBBB", "CCCC", "UUUU", None])
        flights.append((icao24, departure, arrival, rng.choice(DATES)))
    flights.append((None, "DDDD", None, DATES[0]))
    return flights


def enriched_of(spark, flights):
    rows = []
    for icao24, departure, arrival, date in flights:
        route = f"{departure} -> {arrival}" if departure and arrival else None
        rows.append(
            (icao24, None, departure, arrival, None, None, None, route, date, None, "f", None)
            + (None, None, COUNTRY[departure], None, None, COUNTRY[arrival])
        )
    return spark.createDataFrame(rows, ENRICHED_SCHEMA).repartition(4)


def frame(flights):
    f = pd.DataFrame(flights, columns=["icao24", "dep", "arr", "date"], dtype=object)
    f["dep_country"], f["arr_country"] = f["dep"].map(COUNTRY), f["arr"].map(COUNTRY)
    return f


def by_role_and_merge(flights, dimension):
    """Gold the long way round: count each role, outer-merge, add distinct ids of the union."""
    f = frame(flights)
    source = {"airport": ("dep", "arr"), "country": ("dep_country", "arr_country")}[dimension]
    keys = ["date", "airport", "country"] if dimension == "airport" else ["date", "country"]
    sides = []
    for role, column in zip(("dep", "arr"), source):
        side = f.assign(airport=f[role], country=f[f"{role}_country"])
        sides.append(side)
    counted = [
        s.groupby(keys, as_index=False).agg(n=("icao24", "count"), ac=("icao24", "nunique"))
        for s in sides
    ]
    merged = counted[0].merge(counted[1], on=keys, how="outer", suffixes=("_d", "_a")).fillna(0)
    both = pd.concat(sides).groupby(["date", dimension], as_index=False)
    unique = both.agg(unique=("icao24", "nunique"))
    merged = merged.merge(unique, on=["date", dimension], how="left")
    return {
        tuple(r[k] for k in keys)
        + (
            int(r["n_d"]),
            int(r["ac_d"]),
            int(r["n_a"]),
            int(r["ac_a"]),
            int(r["n_d"] + r["n_a"]),
            int(r["unique"]),
        )
        for _, r in merged.iterrows()
    }


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_traffic_tables(spark, seed):
    flights = random_flights(seed)
    enriched = enriched_of(spark, flights)
    airports = rows(traffic.airport_traffic(enriched))
    assert set(airports) == by_role_and_merge(flights, "airport") and len(airports) == len(set(airports))
    assert (DATES[0], "DDDD", "Z", 0, 0, 0, 0, 0, 0) in airports
    countries = rows(traffic.country_traffic(enriched))
    assert set(countries) == by_role_and_merge(flights, "country")
    known = frame(flights).dropna(subset=["dep", "arr", "date"])
    grouped = known.groupby(["date", "dep", "arr"], as_index=False)
    expected = grouped.agg(n=("icao24", "count"), ac=("icao24", "nunique"))
    assert set(rows(traffic.route_traffic(enriched))) == {
        (r["date"], r["dep"], r["arr"], f"{r['dep']} -> {r['arr']}", r["n"], r["ac"])
        for _, r in expected.iterrows()
    }


@pytest.mark.parametrize("seed", [4, 5])
def test_traffic_invariants(spark, seed):
    flights = random_flights(seed)
    enriched = enriched_of(spark, flights)
    for r in traffic.airport_traffic(enriched).collect():
        assert r["total_traffic"] == r["departures"] + r["arrivals"]
        assert max(r["departure_aircraft"], r["arrival_aircraft"]) <= r["unique_aircraft"]
        assert r["unique_aircraft"] <= r["departure_aircraft"] + r["arrival_aircraft"]
    matched = [f for f in flights if f[0] and f[3] and COUNTRY[f[1]]]
    total = traffic.country_traffic(enriched).groupBy().sum("departures").first()[0]
    assert total == len(matched)


def test_roles_merged_equal_one_pass(spark):
    enriched = enriched_of(spark, random_flights(6))
    merged = traffic.merge_roles(
        traffic.airport_departures(enriched),
        traffic.airport_arrivals(enriched),
        ["flight_date", "airport", "country"],
    )
    whole = merged.join(
        traffic.unique_aircraft(enriched, "airport"), ["flight_date", "airport"], "left"
    ).select(*AIRPORT_TRAFFIC.schema.names)
    gold = traffic.airport_traffic(enriched)
    assert whole.exceptAll(gold).isEmpty() and gold.exceptAll(whole).isEmpty()


def test_measures(spark):
    flights = random_flights(7)
    enriched = enriched_of(spark, flights)
    f = frame(flights).dropna(subset=["date"])
    ends = pd.concat(
        [
            f[["icao24"]].assign(airport=f[r], country=f[f"{r}_country"], role=r)
            for r in ("dep", "arr")
        ]
    ).dropna(subset=["country"])
    known = ends.dropna(subset=["icao24"])
    found = measures.kpi_airport(enriched).first().asDict()
    assert found == {
        "departures": int((known["role"] == "dep").sum()),
        "arrivals": int((known["role"] == "arr").sum()),
        "aircraft": known["icao24"].nunique(),
        "total_traffic": len(known),
    }
    by_country = {r["country"]: tuple(r)[1:] for r in measures.kpi_country(enriched).collect()}
    assert by_country == {
        c: (g["icao24"].count(), g["icao24"].nunique(), g["airport"].nunique())
        for c, g in ends.groupby("country")
    }
    routes = f.dropna(subset=["dep", "arr"])
    assert tuple(measures.kpi_route(enriched).first()) == (
        routes["icao24"].count(),
        routes["icao24"].nunique(),
        len(routes.groupby(["dep", "arr"])),
    )
    airports, gold_routes = traffic.airport_traffic(enriched), traffic.route_traffic(enriched)
    for r in measures.kpi_global(airports, gold_routes).collect():
        day = by_role_and_merge([x for x in flights if x[3] == r["flight_date"]], "airport")
        assert r["total_traffic"] == sum(x[7] for x in day)
        assert r["airports"] == len(day) and r["countries"] == len({x[2] for x in day})


def test_trend_and_ranks(spark):
    gold = traffic.route_traffic(enriched_of(spark, random_flights(8)))
    expected = gold.toPandas().sort_values("flight_date")
    grouped = expected.groupby(["departure_airport", "arrival_airport"])["flight_count"]
    expected["change"] = grouped.diff()
    expected = expected.set_index(["flight_date", "departure_airport", "arrival_airport"])["change"]
    for r in measures.trend(gold, ROUTE_TRAFFIC).collect():
        want = expected[(r["flight_date"], r["departure_airport"], r["arrival_airport"])]
        assert r["change"] == (None if np.isnan(want) else want)
    airports = traffic.airport_traffic(enriched_of(spark, random_flights(9)))
    ranked = measures.rank_per_day(airports, {"unique_aircraft": "rank"}).toPandas()
    want = ranked.groupby("flight_date")["unique_aircraft"].rank(method="min", ascending=False)
    assert list(ranked["rank"]) == list(want.astype(int))


def test_slicers(spark):
    gold = traffic.airport_traffic(enriched_of(spark, random_flights(10)))
    everything = rows(gold)
    found = rows(measures.slice_rows(gold, first_date="2026-09-27", country=["X", "Y"], airport="AAAA"))
    assert set(found) == {r for r in everything if r[0] >= DATES[1] and r[2] in "XY" and r[1] == "AAAA"}
    assert sorted(rows(measures.slice_rows(gold, last_date="2026-09-26"))) == sorted(
        r for r in everything if r[0] <= DATES[0]
    )
    assert sorted(rows(measures.slice_rows(gold))) == sorted(everything)


# Deduplication ----------------------------------------------------------------------------


def bronze_rows(seed, n=300):
    rng = random.Random(seed)
    flights = []
    for i in range(n):
        hot = rng.random() < 0.34
        key = ("HOT", "100", "200") if hot else (
            rng.choice([" a1", "A1 ", "a2", "", None]),
            rng.choice(["100", "100.0", "1e2", "300", "bad", "", None]),
            rng.choice(["200", "50", None]),
        )
        file = rng.choice(["f1", "f2", "f3"])
        flights.append(key + (f"cs{i}", file, i))
    return flights


def bronze_frame(spark, flights):
    values = []
    for icao24, first, last, callsign, file, order in flights:
        row = dict.fromkeys(BRONZE_COLUMNS)
        row.update(icao24=icao24, first_seen=first, last_seen=last, callsign=callsign)
        values.append(tuple(row[c] for c in BRONZE_COLUMNS) + (file, order))
    schema = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
    return spark.createDataFrame(values, f"{schema}, bronze_file string, row_order int").repartition(5)


def first_copies(flights):
    def number(text):
        return {"100": 100.0, "100.0": 100.0, "1e2": 100.0, "300": 300.0, "200": 200.0, "50": 50.0}.get(text)

    kept = {}
    for icao24, first, last, callsign, file, order in sorted(flights, key=lambda f: f[4:]):
        key = ((icao24 or "").strip().upper() or None, number(first), number(last))
        kept.setdefault(key, callsign.upper())
    return kept


@pytest.mark.parametrize("seed", [1, 2])
def test_first_copy_is_kept(spark, seed):
    flights = bronze_rows(seed)
    clean = silver.clean_flights(bronze_frame(spark, flights))
    kept = silver.remove_duplicates(clean)
    found = {tuple(r[k] for k in FLIGHT_GRAIN): r["callsign"] for r in kept.collect()}
    expected = first_copies(flights)
    assert found == expected and kept.count() == len(expected)
    again = silver.remove_duplicates(kept)
    assert again.exceptAll(kept).isEmpty() and again.count() == kept.count()
    quality = silver.silver_quality(bronze_frame(spark, flights)).first()
    assert tuple(quality)[:2] == (len(flights) - len(expected), len(expected))


def test_empty_bronze(spark):
    empty = bronze_frame(spark, bronze_rows(1, 1)).limit(0)
    assert silver.build_silver(empty).count() == 0
    assert tuple(silver.silver_quality(empty).first()) == (0, 0, 0, 0, 0)


def test_time_order_and_distances(spark):
    flights = [("A", "200", "100", "c1", "f", 1), ("B", "100", "100", "c2", "f", 2)]
    bronze = bronze_frame(spark, flights).withColumns(
        {
            "departure_airport_horiz_distance": silver.F.lit("-5"),
            "arrival_airport_vert_distance": silver.F.lit("0"),
        }
    )
    found = {r["icao24"]: r for r in silver.clean_flights(bronze).collect()}
    assert found["A"]["departure_time"] is None and found["A"]["arrival_time"] is None
    assert found["B"]["departure_time"] == found["B"]["arrival_time"] is not None
    assert found["A"]["first_seen"] == 200.0
    assert found["A"]["departure_airport_horiz_distance"] is None
    assert found["A"]["arrival_airport_vert_distance"] == 0.0


# Enrichment -------------------------------------------------------------------------------


def test_salted_join_equals_broadcast_join(spark):
    flights = enriched_of(spark, random_flights(11)).select(
        "icao24", "departure_airport", "arrival_airport", "flight_date"
    )
    lookup = spark.createDataFrame(
        [(c, f"{c}-iata", f"{c} Airport", k) for c, k in COUNTRY.items() if k],
        "airport_code string, airport_iata string, airport_name string, country_code string",
    )
    small = enrich.enrich_flights(flights, lookup)
    large = enrich.enrich_flights(flights, lookup, small=False, salts=4)
    assert small.columns == large.columns
    assert small.count() == large.count() == flights.count()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    # Without statistics nothing but the hint can make the join a broadcast join.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            df._jdf.queryExecution().executedPlan().toString()
            for df in (
                enrich.enrich_flights(flights, lookup),
                enrich.enrich_flights(flights, lookup, small=False, salts=4),
            )
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert "SortMergeJoin" in plans[1] and "BroadcastHashJoin" not in plans[1]


def test_lookup_size(spark):
    lookup = spark.createDataFrame([("ab", "é", None)], "a string, b string, c string")
    size = 4 + enrich.ROW_BYTES
    assert enrich.table_bytes(lookup) == size
    assert enrich.table_bytes(lookup.limit(0)) == 0
    assert enrich.is_broadcastable(lookup, size) and not enrich.is_broadcastable(lookup, size - 1)


def test_millions_of_short_rows_are_not_broadcast(spark):
    many = spark.range(2_000_000).selectExpr("cast(id as string) as airport_code", "'x' as country_code")
    assert not enrich.is_broadcastable(many)


def test_flights_without_an_airport_skip_the_salted_join(spark):
    flights = spark.createDataFrame([("A", None), (None, None), ("B", None)], "departure_airport string, n int")
    lookup = spark.createDataFrame(
        [("A", "i", "n", "c")], "airport_code string, airport_iata string, airport_name string, country_code string"
    )
    joined = enrich.enrich_departure(flights, lookup, small=False)
    found = {tuple(r) for r in joined.select("departure_airport", "departure_iata").collect()}
    assert found == {("A", "i"), (None, None), ("B", None)}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_salts_follow_the_partitions():
    assert [enrich.salts_for(n) for n in (4, 200, 4096, 10**6)] == [1, 25, 512, 1024]


def test_cube_counts_each_aircraft_once_at_every_level(spark):
    ends = [("EDDF", "DE"), ("EDDM", "DE"), ("LFPG", "FR"), ("XXXX", None), (None, None)]
    days = [dt.date(2026, 9, 27), dt.date(2026, 9, 28), None]
    rows = [
        (days[i % 3], [f"ac{i % 4}", None][i % 5 == 0], *ends[i % 5], *ends[(i * i + i // 7) % 5])
        for i in range(60)
    ] + [(days[1], None, "LOWW", "AT", None, None)]
    enriched = spark.createDataFrame(
        rows * 2,
        "flight_date date, icao24 string, departure_airport string, departure_country string,"
        " arrival_airport string, arrival_country string",
    )
    expected = {}
    for day, aircraft, *places in rows * 2:
        for role, (airport, country) in enumerate((places[:2], places[2:])):
            if None in (day, airport, country):
                continue
            for level in (0, 1, 3, 4, 5, 7):
                key = (level, day if level < 4 else None, country if not level & 2 else None)
                key += (airport if not level & 1 else None,)
                flights, seen = expected.setdefault(key, ([0, 0], set()))
                if aircraft is not None:
                    flights[role] += 1
                    seen.add(aircraft)
    got = {tuple(r[:4]): tuple(r[4:]) for r in measures.kpi_cube(enriched).collect()}
    assert got == {k: (*n, len(seen), sum(n)) for k, (n, seen) in expected.items()}
