"""Late, repeated and corrected deliveries, in batches and as a stream, against brute force."""

import datetime as dt
import glob
import os
import random

import pytest

import golden
from flightlake.operators import history, traffic, uniques
from flightlake.plans import deliveries
from flightlake.plans.deliveries import DeliveryLake
from flightlake.schemas import AIRPORT_TRAFFIC, BRONZE_COLUMNS, COUNTRY_TRAFFIC, ROUTE_TRAFFIC
from flightlake.sources import bronze
from flightlake.streaming import gold as stream

DAY = 86400
DATES = [dt.date(2026, 9, d) for d in range(25, 30)]


def flight(aircraft, start, departure="VIDP", arrival="VABB", callsign="C"):
    return [aircraft, str(start), departure, str(start + 3600), arrival, callsign] + [""] * 6


def random_flights(seed, n=120):
    """Three deliveries on three dates, with late flights and records delivered again."""
    rng = random.Random(seed)
    codes = ["VIDP", "VABB", "EGLL", "FYWH", "XXXX", ""]
    out = {}
    past = []
    for day in ("2026-09-27", "2026-09-28", "2026-09-29"):
        at = golden.T0 + DAY * (int(day[-2:]) - 27)
        rows = []
        for i in range(n):
            start = at + rng.randrange(24) * 3600 - rng.choice([0, 0, 0, DAY, 2 * DAY])
            rows.append(flight(rng.choice(["a1", "b2", "c3", "d4", ""]), start, rng.choice(codes), rng.choice(codes), f"{day}-{i}"))
        rows += [[*r[:5], f"again {day}", *r[6:]] for r in rng.sample(past, min(len(past), 40))]
        past += rows
        out[day] = rows
    return out


def land(root, days):
    for day, rows in days.items():
        name = f"flights_{day}_00-00_to_02-00.csv"
        golden.write_csv(f"{root}/bronze/{name}", BRONZE_COLUMNS, rows)


def brute_force(days):
    """(date, airport, country) -> counts, each record as first delivered."""
    country = {"VIDP": "IN", "VABB": "IN", "EGLL": "GB", "FYWH": "NA"}
    first = {}
    for day in sorted(days):
        for r in days[day]:
            first.setdefault((r[0], r[1], r[3]), r)
    moves = {}
    for r in first.values():
        date = dt.datetime.fromtimestamp(int(r[1]), dt.UTC).date()
        for at, kind in ((r[2], "d"), (r[4], "a")):
            if at in country:
                moves.setdefault((date, at, country[at]), []).append((kind, r[0]))
    out = set()
    for key, found in moves.items():
        dep, arr = ([a for k, a in found if k == kind and a] for kind in "da")
        out.add((*key, len(dep), len(set(dep)), len(arr), len(set(arr)), len(dep) + len(arr), len({*dep, *arr})))
    return out


@pytest.fixture
def lake(folder):
    return DeliveryLake(folder, golden.write_lake(folder, []))


def gold_rows(spark, lake, table=AIRPORT_TRAFFIC):
    return {tuple(r) for r in history.read_gold(spark, lake.gold(table), table).collect()}


def files(path):
    found = glob.glob(f"{path}/*/*.parquet")
    return {f: os.stat(f).st_mtime_ns for f in found}


def test_late_and_repeated_flights(spark, lake):
    days = random_flights(1)
    land(lake.root, days)
    taken = {day: days[day] for day in ()}
    for day in days:
        touched = deliveries.run_delivery(spark, lake, day)
        taken[day] = days[day]
        assert gold_rows(spark, lake) == brute_force(taken)
        # Late flights touch the dates they departed on, and no others.
        starts = {dt.datetime.fromtimestamp(int(r[1]), dt.UTC).date() for r in days[day]}
        assert set(touched) == starts
    flights = deliveries.all_flights(spark, lake.flights)
    records = {(r[0], r[1], r[3]) for rows in days.values() for r in rows}
    assert flights.count() == len(records)
    # A record keeps what its first delivery said.
    assert flights.where("callsign like 'AGAIN%'").isEmpty()


def test_untouched_dates_stay_as_they_are(spark, lake):
    land(lake.root, {"2026-09-27": [flight("a1", golden.T0), flight("b2", golden.T0 + 60)]})
    land(lake.root, {"2026-09-28": [flight("c3", golden.T0 + DAY), flight("d4", golden.T0 - 60)]})
    deliveries.run_delivery(spark, lake, "2026-09-27")
    before = files(lake.gold(AIRPORT_TRAFFIC))
    deliveries.run_delivery(spark, lake, "2026-09-28")
    after = files(lake.gold(AIRPORT_TRAFFIC))
    assert before.items() <= after.items()
    assert {f.split("flight_date=")[1][:10] for f in set(after) - set(before)} == {"2026-09-26", "2026-09-28"}


def test_a_corrected_delivery_replaces_the_old_one(spark, lake):
    days = {"2026-09-27": [flight("a1", golden.T0), flight("b2", golden.T0 - DAY)]}
    land(lake.root, days)
    deliveries.run_delivery(spark, lake, "2026-09-27")
    again = dict(days)
    deliveries.run_delivery(spark, lake, "2026-09-27")
    assert gold_rows(spark, lake) == brute_force(again)
    # The flight of the day before is taken back: that date's gold ends empty.
    days = {"2026-09-27": days["2026-09-27"][:1]}
    land(lake.root, days)
    assert golden.EVE in deliveries.run_delivery(spark, lake, "2026-09-27")
    assert gold_rows(spark, lake) == brute_force(days)


def test_flights_without_a_date_are_kept_once(spark, lake):
    odd = [["a1", "bad", "VIDP", "", "VABB", "X"] + [""] * 6]
    land(lake.root, {"2026-09-27": odd, "2026-09-28": odd})
    for day in ("2026-09-27", "2026-09-28"):
        assert deliveries.run_delivery(spark, lake, day) == []
    assert deliveries.all_flights(spark, lake.flights).count() == 1


def landed(spark, lake, day, rows):
    name = f"flights_{day}_00-00_to_02-00.csv"
    folder = f"{lake.root}/incoming"
    golden.write_csv(f"{folder}/{name}", BRONZE_COLUMNS, rows)
    bronze.write_landed(bronze.read_bronze(spark, folder, day), lake.bronze, day, [name])


def test_a_stream_gives_what_one_batch_gives(spark, lake):
    days = random_flights(2, 60)
    lookup = deliveries.read_lookup(spark, lake)
    first, *later = days
    landed(spark, lake, first, days[first])
    stream.catch_up(spark, lake, lookup)
    assert gold_rows(spark, lake) == brute_force({first: days[first]})
    before = files(lake.gold(AIRPORT_TRAFFIC))
    stream.catch_up(spark, lake, lookup)
    assert files(lake.gold(AIRPORT_TRAFFIC)) == before  # nothing new has landed
    for day in later:
        landed(spark, lake, day, days[day])
    stream.catch_up(spark, lake, lookup, files_per_batch=1)
    assert gold_rows(spark, lake) == brute_force(days)
    # All of it as one delivery.
    whole = DeliveryLake(f"{lake.root}/whole", lake.airports_csv)
    read = spark.read.schema(stream.STREAM_SCHEMA).parquet(bronze.landed_path(lake.bronze))
    deliveries.take(spark, whole, read.select(*BRONZE_COLUMNS, bronze.LINEAGE, bronze.ROW_ORDER), "1", lookup)
    for table in (AIRPORT_TRAFFIC, COUNTRY_TRAFFIC, ROUTE_TRAFFIC):
        assert gold_rows(spark, whole, table) == gold_rows(spark, lake, table)
    # A batch that is run again changes nothing.
    rows = read.where(f"ingest_date = '{first}'").select(*BRONZE_COLUMNS, bronze.LINEAGE, bronze.ROW_ORDER)
    deliveries.take(spark, lake, rows, stream.batch_name(0), lookup)
    assert gold_rows(spark, lake) == brute_force(days)


def test_numbers_of_aircraft_stay_and_go_on(spark):
    def frame(names):
        return spark.createDataFrame([(n,) for n in names], "icao24 string")

    first = uniques.number_aircraft(frame([f"a{i % 50}" for i in range(200)] + [None]))
    old = {r.icao24: r.aircraft_id for r in first.collect()}
    assert sorted(old.values()) == list(range(1, 51))
    known = spark.createDataFrame(list(old.items()), "icao24 string, aircraft_id long")
    more = uniques.number_aircraft(frame([f"a{i}" for i in range(40, 70)]), known)
    new = {r.icao24: r.aircraft_id for r in more.collect()}
    assert sorted(new.values()) == list(range(1, 71))
    assert old.items() <= new.items()


def test_bitmaps_count_like_the_flights(spark, lake):
    days = random_flights(3)
    land(lake.root, days)
    for day in days:
        deliveries.run_delivery(spark, lake, day)
    enriched = spark.read.parquet(lake.by_date)
    # Numbers that fill several buckets.
    numbers = uniques.number_aircraft(enriched).selectExpr("icao24", "aircraft_id * 40000 as aircraft_id")
    bitmaps = uniques.daily_bitmaps(enriched, numbers, "airport")
    for first, last in ((DATES[0], DATES[-1]), (DATES[1], DATES[2])):
        seen = traffic.movements(enriched).where(f"flight_date between '{first}' and '{last}' and airport is not null")
        want = {}
        for r in seen.where("icao24 is not null").collect():
            want.setdefault(r.airport, set()).add(r.icao24)
        got = {r.airport: r.aircraft for r in uniques.aircraft_between(bitmaps, "airport", first, last).collect()}
        assert got == {a: len(s) for a, s in want.items()}
