"""Shape of the physical plans: what must not creep in."""

import pytest

from flightlake import catalog
from flightlake.operators import enrich, history, measures, silver, traffic
from flightlake.schemas import AIRPORT_TRAFFIC, ENRICHED_SCHEMA
from flightlake.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    return catalog.Lakehouse(spark, SF)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - catalog.STORED))
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(catalog.run(name, spark, SF))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_parsing_is_not_copied_by_pushed_filters(lake):
    for df in (lake.silver, lake.airports, lake.countries, lake.routes):
        assert 2 <= plan(df).count("regexp_extract") <= 4


def test_distinct_counts_do_not_copy_rows(lake):
    for df in (lake.airports, lake.countries, lake.routes):
        assert "Expand" not in plan(df)
    for kpi in (measures.kpi_airport, measures.kpi_country, measures.kpi_route):
        assert "Expand" not in plan(kpi(lake.enriched))


def test_traffic_counts_per_aircraft_before_it_shuffles(lake):
    text = plan(traffic.airport_traffic(lake.enriched))
    wanted = r"hashpartitioning\(flight_date#\d+, airport#\d+, country#\d+, icao24#\d+"
    import re

    assert re.search(wanted, text)
    assert "partial_count" in text


def test_duplicates_are_limited_before_the_shuffle(lake):
    text = plan(silver.build_silver(lake.bronze))
    assert text.count("WindowGroupLimit") == 2


def test_lookup_is_broadcast_and_flights_stay_in_place(lake):
    flights = lake.bronze.select("icao24", "departure_airport", "arrival_airport")
    text = plan(enrich.enrich_flights(flights, lake.lookup))
    above = text[: text.index("lineitem.parquet")]
    assert "BroadcastHashJoin [departure_airport" in above
    assert "BroadcastHashJoin [arrival_airport" in above


def test_top_k_needs_no_full_sort(lake):
    assert "TakeOrderedAndProject" in plan(measures.top_k(lake.airports, AIRPORT_TRAFFIC))
    assert plan(measures.top_k_per_day(lake.routes, catalog.ROUTE_TRAFFIC)).count("WindowGroupLimit") > 2


def test_unused_columns_are_not_read(lake):
    text = plan(lake.airports)
    assert "l_quantity" not in text and "distance" not in text and "callsign" not in text


def test_single_dates_read_single_partitions(spark, folder, lake):
    history.write_gold(lake.airports, f"{folder}/gold", AIRPORT_TRAFFIC)
    gold = history.read_gold(spark, f"{folder}/gold", AIRPORT_TRAFFIC)
    text = plan(measures.slice_rows(gold, first_date="1995-07-12", last_date="1995-07-12", country="ASIA"))
    assert "PartitionFilters: [isnotnull(flight_date" in text
    assert "EqualTo(country,ASIA)" in text
    tables.write_day(lake.enriched, f"{folder}/enriched", "1995-07-12")
    day = tables.read_day(spark, f"{folder}/enriched", ENRICHED_SCHEMA, "1995-07-12")
    text = plan(traffic.airport_traffic(traffic.filter_date(day, "1995-07-12")))
    assert "ingest_date=1995-07-12]" in text
    assert "EqualTo(flight_date,1995-07-12)" in text
    read = text[text.index("ReadSchema") :]
    assert "departure_airport_name" not in read and "callsign" not in read


def test_one_small_file_per_date(spark, folder, lake):
    import glob

    history.write_gold(lake.airports, f"{folder}/gold", AIRPORT_TRAFFIC)
    dates = glob.glob(f"{folder}/gold/flight_date=*")
    assert len(dates) == len(glob.glob(f"{folder}/gold/flight_date=*/*.parquet")) > 100


def test_calendar_and_cube_shuffle_once_for_each_grouping(lake):
    trend = plan(measures.calendar_trend(lake.airports, AIRPORT_TRAFFIC))
    above = trend[: trend.index("HashAggregate")]
    assert above.count("Exchange") == 1 and "Join" not in above
    cube = plan(measures.kpi_cube(lake.enriched))
    # Rows are copied to the levels after they were folded to one per aircraft and airport.
    assert cube.index("Expand") < cube.index("icao24", cube.index("Expand"))
    below = cube[cube.index("Expand") :]
    assert "HashAggregate" in below[: below.index("Generate")]


def test_rows_copied_to_the_levels_have_no_aircraft(lake):
    text = plan(measures.kpi_cube(lake.enriched))
    expand = text[text.index("Expand") :].split("\n")[0]
    assert "flight_date" in expand and "icao24" not in expand


def test_dates_of_deliveries_are_read_from_their_own_folders(spark, folder):
    import datetime as dt

    from flightlake.plans import deliveries

    rows = spark.range(6).selectExpr(
        "cast(id as string) icao24", "cast(id as double) first_seen", "cast(id as double) last_seen",
        "date_add(date'2026-09-01', cast(id as int)) flight_date", "'1' delivery",
    )
    missing = [f for f in deliveries.FLIGHTS_SCHEMA if f.name not in rows.columns]
    from pyspark.sql import functions as F

    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    rows.write.partitionBy("flight_date", "delivery").parquet(folder + "/flights")
    read = deliveries.flights_on(spark, folder + "/flights", [dt.date(2026, 9, 2), dt.date(2030, 1, 1)])
    assert [r.icao24 for r in read.collect()] == ["1"]
    assert len(read.inputFiles()) == 1
    assert "WindowGroupLimit" in plan(read)


def test_bitmaps_are_made_where_their_numbers_meet(lake):
    from flightlake.operators import uniques

    text = plan(uniques.daily_bitmaps(lake.enriched, uniques.number_aircraft(lake.silver), "airport"))
    made = text[: text.index("Exchange")]
    assert made.count("bitmap_construct_agg") >= 2 and "REPARTITION_BY_COL" in text


@pytest.mark.parametrize("name", ["stored_replace_country", "stored_upsert_route"])
def test_stored_gold_is_made_once_from_the_tables(spark, folder, name, monkeypatch):
    from flightlake.sources import tables

    written, write = [], tables._write

    def watched(df, path, *columns):
        written.append("lineitem.parquet" in plan(df))
        write(df, path, *columns)

    monkeypatch.setattr(tables, "_write", watched)
    catalog.run(name, spark, SF)
    assert len(written) > 1 and not any(written)
