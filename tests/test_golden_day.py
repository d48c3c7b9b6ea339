import glob
import json
import os

import pytest
from pyspark.errors import AnalysisException

import golden
from flightlake.functions import times
from flightlake.operators import enrich, history, measures, silver, traffic
from flightlake.plans import day as daily
from flightlake.plans import windows
from flightlake.schemas import (
    AIRPORT_TRAFFIC,
    BRONZE_COLUMNS,
    COUNTRY_TRAFFIC,
    ENRICHED_COLUMNS,
    GOLD_TABLES,
    ROUTE_TRAFFIC,
    SILVER_COLUMNS,
    SILVER_SCHEMA,
)
from flightlake.sources import airports, bronze, tables

EXPECTED = {
    "airport_traffic": golden.AIRPORT_TRAFFIC,
    "country_traffic": golden.COUNTRY_TRAFFIC,
    "route_traffic": golden.ROUTE_TRAFFIC,
}


@pytest.fixture
def lake(folder):
    return daily.Lake(folder, golden.write_lake(folder))


def batches(spark, lake):
    return bronze.read_bronze(spark, lake.bronze, golden.DAY)


def test_bronze_scan_has_all_batches_and_lineage(spark, lake):
    scan = batches(spark, lake)
    assert scan.columns == BRONZE_COLUMNS + ["bronze_file", "row_order"]
    counts = dict(golden.rows(bronze.batch_counts(scan)))
    assert counts == {golden.F0: 6, golden.F1: 6}
    assert golden.rows(bronze.batch_totals(scan)) == [(2, 12)]
    ids = [r["icao24"] for r in scan.orderBy("bronze_file", "row_order").collect()]
    assert ids[0] == " 4ca1fa " and ids[2] == "004012" and ids[-1] == "800ac1"


def test_no_batches_for_a_date_is_an_error(spark, lake):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        bronze.read_bronze(spark, lake.bronze, "2026-09-28")
    with pytest.raises(ValueError):
        bronze.read_bronze(spark, lake.bronze, "27.09.2026")


def test_untidy_headers_are_normalised(spark, folder):
    header = [f" {c.upper().replace('_', ' ')} " for c in BRONZE_COLUMNS]
    golden.write_csv(
        f"{folder}/bronze/{golden.F0}", header, [golden.bronze_row(golden.FLIGHTS[2])]
    )
    scan = bronze.read_bronze(spark, f"{folder}/bronze", golden.DAY)
    assert golden.rows(scan.select("icao24", "arrival_airport")) == [("004012", "EGLL")]


def test_columns_are_matched_by_name(spark, lake):
    """Batches with columns in another order, or fewer of them, join the others."""
    moved = BRONZE_COLUMNS[::-1]
    golden.write_csv(f"{lake.bronze}/{golden.F2}", moved, [list("abcdefghijkl")])
    fewer = BRONZE_COLUMNS[:6]
    late = golden.F2.replace("04-00_to_06-00", "06-00_to_08-00")
    golden.write_csv(f"{lake.bronze}/{late}", [*fewer, "other"], [list("mnopqrs"), list("tuvwxyz")])
    scan = batches(spark, lake)
    assert scan.columns == BRONZE_COLUMNS + ["bronze_file", "row_order"]
    assert scan.count() == 15
    odd = scan.where("bronze_file = 'X' or icao24 in ('l', 'm', 't')")
    found = golden.rows(odd.orderBy("bronze_file", "row_order").drop("row_order", "bronze_file"))
    assert found[0] == tuple("lkjihgfedcba")
    assert found[1:] == [(*"mnopqr", *[None] * 6), (*"tuvwxy", *[None] * 6)]
    # Row order, and with it the first copy of a flight, is that of the files.
    order = scan.where(f"bronze_file = '{late}'").orderBy("row_order")
    assert [r["icao24"] for r in order.collect()] == ["m", "t"]


@pytest.mark.parametrize("fields", [["a"] * 14, ["a"] * 3])
def test_a_ragged_row_is_an_error(spark, lake, fields):
    with open(f"{lake.bronze}/{golden.F1}", "a") as out:
        out.write(",".join(fields) + "\n")
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == "true"
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        batches(spark, lake).collect()
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        batches(spark, lake).select("icao24").collect()


def test_silver(spark, lake):
    table = silver.build_silver(batches(spark, lake))
    assert table.columns == SILVER_COLUMNS
    assert [f.dataType for f in table.schema] == [f.dataType for f in SILVER_SCHEMA]
    found = golden.rows(table, ["processed_at"])
    assert len(found) == 11 and set(found) == golden.SILVER
    assert table.where("processed_at is null").isEmpty()


def test_silver_quality(spark, lake):
    assert golden.rows(silver.silver_quality(batches(spark, lake))) == [(1, 11, 10, 11, 10)]


def test_lookup_keeps_the_first_of_a_code(spark, lake):
    lookup = enrich.build_lookup(airports.read_airports(spark, lake.airports_csv))
    assert set(golden.rows(lookup)) == {
        ("VIDP", "DEL", "Indira Gandhi Intl", "IN"),
        ("VABB", "BOM", "Mumbai Intl", "IN"),
        ("EGLL", "LHR", "Heathrow", "GB"),
        ("FYWH", "WDH", "Hosea Kutako", "NA"),
    }


def test_missing_airport_column_is_an_error(spark, folder):
    golden.write_csv(f"{folder}/a.csv", ["ident", "name"], [["VIDP", "x"]])
    with pytest.raises(AnalysisException):
        airports.read_airports(spark, f"{folder}/a.csv")


def test_enrichment_and_match_stats(spark, lake):
    flights = silver.build_silver(batches(spark, lake))
    lookup = enrich.build_lookup(airports.read_airports(spark, lake.airports_csv))
    enriched = enrich.enrich_flights(flights, lookup)
    assert enriched.columns == ENRICHED_COLUMNS
    assert golden.rows(enrich.match_stats(enriched, lookup)) == [(11, 9, 11, 4)]
    unmatched = enriched.where("departure_airport = 'XXXX'").select(
        "departure_iata", "departure_airport_name", "departure_country", "arrival_iata"
    )
    assert golden.rows(unmatched) == [(None, None, None, "BOM")]


def test_run_day(spark, lake):
    gold = daily.run_day(spark, lake, golden.DAY)
    for name, expected in EXPECTED.items():
        found = golden.rows(gold[name])
        assert len(found) == len(expected) and set(found) == expected
    stored = tables.read_day(spark, lake.silver, SILVER_SCHEMA, golden.DAY)
    assert set(golden.rows(stored, ["processed_at"])) == golden.SILVER
    stats = traffic.run_stats(
        tables.read_day(spark, lake.enriched, daily.ENRICHED_SCHEMA, golden.DAY),
        golden.DAY,
        *[gold[t.name] for t in GOLD_TABLES],
    )
    assert golden.rows(stats) == [(11, 8, 4, 3, 6)]


def test_day_report(spark, lake):
    daily.run_day(spark, lake, golden.DAY)
    assert daily.day_report(spark, lake, golden.DAY).first().asDict() == {
        "bronze_rows": 12,
        "duplicates_removed": 1,
        "silver_rows": 11,
        "rows_with_departure": 10,
        "rows_with_arrival": 11,
        "rows_with_route": 10,
        "departures_matched": 9,
        "arrivals_matched": 11,
        "rows_on_date": 8,
        "airport_traffic_rows": 4,
        "country_traffic_rows": 3,
        "route_traffic_rows": 6,
    }


def test_dates_are_utc_whatever_the_session_says(spark, lake):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    gold = daily.run_day(spark, lake, golden.DAY)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert set(golden.rows(gold["route_traffic"])) == golden.ROUTE_TRAFFIC


def test_run_day_twice_changes_nothing(spark, lake):
    daily.run_day(spark, lake, golden.DAY)
    gold = daily.run_day(spark, lake, golden.DAY)
    for name, expected in EXPECTED.items():
        assert sorted(golden.rows(gold[name])) == sorted(expected)


def test_late_delivery_does_not_touch_the_day_before(spark, lake):
    eve = golden.F0.replace("27", "26")
    golden.write_csv(
        f"{lake.bronze}/{eve}",
        BRONZE_COLUMNS,
        [["aaa111", golden.T0 - 7200, "VIDP", golden.T0 - 3600, "VABB", "EVE1"] + [""] * 6],
    )
    daily.run_day(spark, lake, "2026-09-26")
    gold = daily.run_day(spark, lake, golden.DAY)
    # The flight of 23:50 came with the next day's batches and stays out of both days.
    eve_rows = gold["route_traffic"].where("flight_date = DATE '2026-09-26'")
    assert golden.rows(eve_rows) == [(golden.EVE, "VIDP", "VABB", "VIDP -> VABB", 1, 1)]
    today = gold["route_traffic"].where("flight_date = DATE '2026-09-27'")
    assert set(golden.rows(today)) == golden.ROUTE_TRAFFIC


def test_day_without_departures_is_an_error(spark, folder):
    flights = [f for f in golden.FLIGHTS if f[6] in ("BAD1", "PREV")]
    lake = daily.Lake(folder, golden.write_lake(folder, flights))
    with pytest.raises(ValueError, match="no flights"):
        daily.run_day(spark, lake, golden.DAY)


def test_na_tokens_drop_namibia(spark, lake):
    gold = daily.run_day(spark, lake, golden.DAY, na_tokens=("NA",))
    assert set(golden.rows(gold["airport_traffic"])) == {
        r for r in golden.AIRPORT_TRAFFIC if r[2] != "NA"
    }
    assert set(golden.rows(gold["country_traffic"])) == {
        r for r in golden.COUNTRY_TRAFFIC if r[1] != "NA"
    }
    assert set(golden.rows(gold["route_traffic"])) == golden.ROUTE_TRAFFIC


def test_all_missing_tokens(spark, lake):
    from flightlake.functions import text

    scan = bronze.read_bronze(spark, lake.bronze, golden.DAY, text.MISSING_TOKENS)
    assert scan.where("icao24 = '' or callsign = ''").isEmpty() and scan.count() == 12


FIELDS = ["icao24", "firstSeen", "estDepartureAirport", "lastSeen", "estArrivalAirport", "callsign"]


def write_payloads(folder, flights=golden.FLIGHTS):
    """A payload for each window of the day, empty ones included."""
    os.makedirs(folder, exist_ok=True)
    for window in windows.day_windows(golden.DAY):
        batch = times.window_label_of(*window)
        objects = [dict(zip(FIELDS, f[1:])) for f in flights if f[0] == batch]
        with open(f"{folder}/{batch.replace('.csv', '.json')}", "w") as out:
            json.dump(objects, out)
    return folder


@pytest.fixture
def landing(folder):
    """A lake without batches, and the golden day's payloads."""
    reference = golden.write_lake(f"{folder}/unused", flights=[])
    return daily.Lake(f"{folder}/lake", reference), write_payloads(f"{folder}/payload")


def landed_files(lake):
    found = glob.glob(f"{lake.bronze}/landed/**/*.parquet", recursive=True)
    return {(f, os.stat(f).st_mtime_ns) for f in found}


def test_payload_to_bronze_to_gold(spark, landing):
    """The same flights landed from JSON payloads instead of ready CSV files."""
    lake, payloads = landing
    landed = daily.land_day(spark, lake, payloads, golden.DAY)
    arrived = {r["bronze_file"]: r["row_count"] for r in landed.collect()}
    assert len(arrived) == 12 and sum(arrived.values()) == 12
    assert arrived[golden.F0] == arrived[golden.F1] == 6 and arrived[golden.F2] == 0
    scan = bronze.read_bronze(spark, lake.bronze, golden.DAY)
    raw = scan.where("callsign = 'ai101 '").select("icao24", "first_seen", "arrival_airport")
    assert golden.rows(raw) == [(" 4ca1fa ", str(golden.T0 + 3600), "VABB ")]
    ids = [r["icao24"] for r in scan.orderBy("bronze_file", "row_order").collect()]
    assert ids == [f[1] for f in golden.FLIGHTS]
    gold = daily.run_day(spark, lake, golden.DAY)
    for name, expected in EXPECTED.items():
        assert set(golden.rows(gold[name])) == expected


def test_a_missing_payload_stops_before_anything_is_written(spark, landing):
    lake, payloads = landing
    daily.land_day(spark, lake, payloads, golden.DAY)
    before = landed_files(lake)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        daily.land_day(spark, lake, f"{payloads}-mistyped", golden.DAY)
    os.remove(f"{payloads}/{golden.F1.replace('.csv', '.json')}")
    with pytest.raises(ValueError, match="02-00_to_04-00"):
        daily.land_day(spark, lake, payloads, golden.DAY)
    assert landed_files(lake) == before


def test_a_cut_off_payload_is_an_error(spark, landing):
    lake, payloads = landing
    daily.land_day(spark, lake, payloads, golden.DAY)
    before = landed_files(lake)
    path = f"{payloads}/{golden.F0.replace('.csv', '.json')}"
    with open(path) as file:
        text = file.read()
    for cut in (len(text) // 2, len(text) - 1):
        with open(path, "w") as out:
            out.write(text[:cut])
        with pytest.raises(Exception, match="(?i)malformed"):
            daily.land_day(spark, lake, payloads, golden.DAY)
    assert landed_files(lake) == before


def test_several_files_per_window(spark, landing):
    """Parts of a window, arrays and lines, land in one job and in their order."""
    lake, payloads = landing
    window = golden.F0.removesuffix(".csv")
    os.remove(f"{payloads}/{window}.json")
    objects = [dict(zip(FIELDS, f[1:])) for f in golden.FLIGHTS if f[0] == golden.F0]
    with open(f"{payloads}/{window}-part-0.json", "w") as out:
        json.dump(objects[:2], out)
    with open(f"{payloads}/{window}-part-1.jsonl", "w") as out:
        out.writelines(json.dumps(o) + "\n" for o in objects[2:5])
    with open(f"{payloads}/{window}-part-2.json", "w") as out:
        json.dump(objects[5:], out)
    daily.land_day(spark, lake, payloads, golden.DAY)
    scan = bronze.read_bronze(spark, lake.bronze, golden.DAY)
    ids = [r["icao24"] for r in scan.orderBy("bronze_file", "row_order").collect()]
    assert ids == [f[1] for f in golden.FLIGHTS]
    assert dict(golden.rows(bronze.batch_counts(scan))) == {golden.F0: 6, golden.F1: 6}


def test_bronze_keeps_every_text_as_it_was(spark, landing):
    lake, payloads = landing
    odd = ['line\nbreak', '"quoted", with comma', "  padded\t", "", None, "back\\slash", "é\r\n"]
    path = f"{payloads}/{golden.F0.replace('.csv', '.json')}"
    with open(path, "w") as out:
        json.dump([{"icao24": str(i), "callsign": t} for i, t in enumerate(odd)], out)
    daily.land_day(spark, lake, payloads, golden.DAY)
    scan = bronze.read_bronze(spark, lake.bronze, golden.DAY).where(f"bronze_file = '{golden.F0}'")
    found = scan.orderBy("row_order").select("icao24", "callsign")
    assert golden.rows(found) == [(str(i), t) for i, t in enumerate(odd)]


def test_landing_again_replaces_each_window(spark, landing, folder):
    lake, payloads = landing
    daily.land_day(spark, lake, payloads, golden.DAY)
    # A ready CSV of a landed batch is an older delivery.
    golden.write_csv(f"{lake.bronze}/{golden.F0}", BRONZE_COLUMNS, [["old"] * 12])
    fewer = write_payloads(f"{folder}/again", [f for f in golden.FLIGHTS if f[0] == golden.F1])
    landed = daily.land_day(spark, lake, fewer, golden.DAY)
    arrived = {r["bronze_file"]: r["row_count"] for r in landed.collect()}
    assert arrived[golden.F0] == 0 and arrived[golden.F1] == 6 and sum(arrived.values()) == 6


def test_emptied_batches_leave_no_stale_tables(spark, lake):
    """All batches become empty: silver does too, and the run stops."""
    daily.run_day(spark, lake, golden.DAY)
    for batch in (golden.F0, golden.F1, golden.F2):
        golden.write_csv(f"{lake.bronze}/{batch}", BRONZE_COLUMNS, [])
    with pytest.raises(ValueError, match="no flights"):
        daily.run_day(spark, lake, golden.DAY)
    assert tables.read_day(spark, lake.silver, SILVER_SCHEMA, golden.DAY).isEmpty()
    assert tables.read_day(spark, lake.enriched, daily.ENRICHED_SCHEMA, golden.DAY).isEmpty()


def test_empty_gold_replaces_the_date_and_no_other(spark, lake):
    """A reference that matches nothing leaves routes only, on that date only."""
    eve = golden.F0.replace("27", "26")
    flight = ["aaa111", golden.T0 - 7200, "VIDP", golden.T0 - 3600, "VABB", "EVE1"]
    golden.write_csv(f"{lake.bronze}/{eve}", BRONZE_COLUMNS, [flight + [""] * 6])
    daily.run_day(spark, lake, "2026-09-26")
    daily.run_day(spark, lake, golden.DAY)

    def eve_files():
        found = glob.glob(f"{lake.root}/gold/*/flight_date=2026-09-26/*")
        return {(f, os.stat(f).st_mtime_ns) for f in found}

    before = eve_files()
    header = ["ident", "name", "iso_country", "icao_code", "iata_code"]
    golden.write_csv(lake.airports_csv, header, [["Q", "Nowhere", "QQ", "QQQQ", ""]])
    daily.run_day(spark, lake, golden.DAY)
    counts = {
        t.name: history.read_gold_day(spark, lake.gold(t), golden.DAY, t).count() for t in GOLD_TABLES
    }
    assert counts == {"airport_traffic": 0, "country_traffic": 0, "route_traffic": 6}
    assert before and eve_files() == before


def test_last_window_of_a_day_is_labelled_with_its_start_date():
    cuts = windows.day_windows(golden.DAY)
    assert len(cuts) == 12
    assert times.window_label_of(*cuts[-1]) == "flights_2026-09-27_22-00_to_00-00.csv"


def test_payload_without_a_field(spark):
    from flightlake.sources import payload

    partial = spark.createDataFrame([("a", 5)], "icao24 string, firstSeen long")
    row = payload.project_payload(partial).first()
    assert list(row.asDict()) == BRONZE_COLUMNS
    assert row["first_seen"] == "5" and row["callsign"] is None


def test_airport_names_with_quotes_commas_and_line_breaks(spark, folder):
    name = 'Robert "Bob" Field,\nNorth'
    header = ["ident", "name", "iso_country", "icao_code", "iata_code"]
    golden.write_csv(f"{folder}/r/a.csv", header, [["K1", name, "US", "KBOB", ""], ["K2", "x", "US", "kbob", ""]])
    lookup = enrich.build_lookup(airports.read_airports(spark, f"{folder}/r/a.csv"))
    assert golden.rows(lookup) == [("KBOB", None, name, "US")]


def test_warehouse_load(spark, lake):
    daily.run_day(spark, lake, golden.DAY)
    daily.load_warehouse(spark, lake)
    daily.load_warehouse(spark, lake, golden.DAY)
    for table in GOLD_TABLES:
        stored = history.read_gold(spark, lake.warehouse(table), table)
        assert sorted(golden.rows(stored)) == sorted(EXPECTED[table.name])


def test_top_k(spark, lake):
    gold = daily.run_day(spark, lake, golden.DAY)
    top = measures.top_k(gold["airport_traffic"], AIRPORT_TRAFFIC, 2)
    assert [r["airport"] for r in top.collect()] == ["VABB", "VIDP"]
    top = measures.top_k(gold["country_traffic"], COUNTRY_TRAFFIC, 1)
    assert [r["country"] for r in top.collect()] == ["IN"]
    top = measures.top_k(gold["route_traffic"], ROUTE_TRAFFIC, 3)
    assert [r["route"] for r in top.collect()] == ["FYWH -> EGLL", "VABB -> VABB", "VABB -> VIDP"]


def bytes_read(spark):
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(stats.get(i).getBytesRead() for i in range(stats.size()))


def test_headers_are_read_without_the_data(spark, folder):
    """Of large files only the beginning is read to tell their columns."""
    line = ",".join(["x" * 40] * len(BRONZE_COLUMNS)) + "\n"
    os.makedirs(f"{folder}/bronze")
    for name in (golden.F0, golden.F1):
        with open(f"{folder}/bronze/{name}", "w") as out:
            out.write(",".join(BRONZE_COLUMNS) + "\n")
            out.writelines([line] * 40_000)
    size = os.path.getsize(f"{folder}/bronze/{golden.F0}")
    before = bytes_read(spark)
    found = bronze.csv_headers(spark, bronze.batch_glob(f"{folder}/bronze", golden.DAY))
    assert [len(paths) for paths in found.values()] == [2]
    assert bytes_read(spark) - before < size / 10


def test_a_file_without_lines_has_no_header(spark, lake):
    open(f"{lake.bronze}/{golden.F2}", "w").close()
    assert batches(spark, lake).count() == 12


def test_counts_of_a_run_are_taken_on_the_way(spark, lake):
    found = daily.silver_day(spark, lake, golden.DAY)
    assert found == silver.silver_quality(batches(spark, lake)).first().asDict()
    assert daily.enrich_day(spark, lake, golden.DAY) == {
        "flights": 11, "departures_matched": 9, "arrivals_matched": 11,
    }
    # An empty day is counted, too.
    for name in (golden.F0, golden.F1):
        golden.write_csv(f"{lake.bronze}/{name}", BRONZE_COLUMNS, [])
    assert set(daily.silver_day(spark, lake, golden.DAY).values()) == {0}
