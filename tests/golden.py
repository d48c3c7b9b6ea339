"""The golden day: twelve raw flights in two batches, six airports, expected tables."""

import csv
import datetime as dt
import os

from flightlake.schemas import AIRPORT_COLUMNS, BRONZE_COLUMNS

DAY = "2026-09-27"
T0 = 1790467200
F0 = "flights_2026-09-27_00-00_to_02-00.csv"
F1 = "flights_2026-09-27_02-00_to_04-00.csv"
F2 = "flights_2026-09-27_04-00_to_06-00.csv"

# file, icao24, first_seen, departure_airport, last_seen, arrival_airport, callsign
FLIGHTS = [
    (F0, " 4ca1fa ", T0 + 3600, "vidp", T0 + 10800, "VABB ", "ai101 "),
    (F0, "4ca1fa", T0 + 14400, "VABB", T0 + 21600, "VIDP", "AI102"),
    (F0, "004012", T0 + 3600, "VIDP", T0 + 9000, "EGLL", "BA142"),
    (F0, "800abc", T0 + 7200, "VIDP", T0 + 3600, "VABB", "BAD1"),
    (F0, "800abd", T0 + 7200, "   ", T0 + 9000, "VABB", ""),
    (F0, "800abe", T0 + 7200, "XXXX", T0 + 9000, "VABB", "UM1"),
    (F1, "4CA1FA", T0 + 3600, "VIDP", T0 + 10800, "VABB", "DUP"),
    (F1, "800abf", T0 - 600, "VIDP", T0 + 600, "VABB", "PREV"),
    (F1, "800abf", T0 + 10800, "VABB", T0 + 12600, "VABB", "LOOP"),
    (F1, "", T0 + 10800, "VABB", T0 + 14400, "VIDP", "NOID"),
    (F1, "800ac0", "bad", "VIDP", T0 + 14400, "VABB", "BADTS"),
    (F1, "800ac1", T0 + 18000, "FYWH", T0 + 18000, "EGLL", "SW1"),
]

AIRPORTS = [
    ("VIDP", "Indira Gandhi Intl", "IN", "vidp", "DEL"),
    ("VABB", "Mumbai Intl", "in ", " VABB", "BOM"),
    ("EGLL", "Heathrow", "GB", "EGLL", "LHR"),
    ("EGLL2", "Heathrow copy", "XX", "egll", "LHR"),
    ("FYWH", "Hosea Kutako", "NA", "FYWH", "WDH"),
    ("IN-1", "No code strip", "IN", "", ""),
]


def at(day, hour, minute=0):
    return dt.datetime(2026, 9, day, hour, minute)


TODAY = dt.date(2026, 9, 27)
EVE = dt.date(2026, 9, 26)

# icao24, callsign, dep, arr, departure_time, arrival_time, minutes, route, date, hour, file
SILVER = {
    ("4CA1FA", "AI101", "VIDP", "VABB", at(27, 1), at(27, 3), 120.0, "VIDP -> VABB", TODAY, 1, F0),
    ("4CA1FA", "AI102", "VABB", "VIDP", at(27, 4), at(27, 6), 120.0, "VABB -> VIDP", TODAY, 4, F0),
    ("004012", "BA142", "VIDP", "EGLL", at(27, 1), at(27, 2, 30), 90.0, "VIDP -> EGLL", TODAY, 1, F0),
    ("800ABC", "BAD1", "VIDP", "VABB", None, None, None, "VIDP -> VABB", None, None, F0),
    ("800ABD", None, None, "VABB", at(27, 2), at(27, 2, 30), 30.0, None, TODAY, 2, F0),
    ("800ABE", "UM1", "XXXX", "VABB", at(27, 2), at(27, 2, 30), 30.0, "XXXX -> VABB", TODAY, 2, F0),
    ("800ABF", "PREV", "VIDP", "VABB", at(26, 23, 50), at(27, 0, 10), 20.0, "VIDP -> VABB", EVE, 23, F1),
    ("800ABF", "LOOP", "VABB", "VABB", at(27, 3), at(27, 3, 30), 30.0, "VABB -> VABB", TODAY, 3, F1),
    (None, "NOID", "VABB", "VIDP", at(27, 3), at(27, 4), 60.0, "VABB -> VIDP", TODAY, 3, F1),
    ("800AC0", "BADTS", "VIDP", "VABB", None, at(27, 4), None, "VIDP -> VABB", None, None, F1),
    ("800AC1", "SW1", "FYWH", "EGLL", at(27, 5), at(27, 5), 0.0, "FYWH -> EGLL", TODAY, 5, F1),
}

AIRPORT_TRAFFIC = {
    (TODAY, "VABB", "IN", 2, 2, 4, 4, 6, 4),
    (TODAY, "VIDP", "IN", 2, 2, 1, 1, 3, 2),
    (TODAY, "EGLL", "GB", 0, 0, 2, 2, 2, 2),
    (TODAY, "FYWH", "NA", 1, 1, 0, 0, 1, 1),
}

COUNTRY_TRAFFIC = {
    (TODAY, "IN", 4, 3, 5, 4, 9, 5),
    (TODAY, "GB", 0, 0, 2, 2, 2, 2),
    (TODAY, "NA", 1, 1, 0, 0, 1, 1),
}

ROUTE_TRAFFIC = {
    (TODAY, "FYWH", "EGLL", "FYWH -> EGLL", 1, 1),
    (TODAY, "VABB", "VABB", "VABB -> VABB", 1, 1),
    (TODAY, "VABB", "VIDP", "VABB -> VIDP", 1, 1),
    (TODAY, "VIDP", "EGLL", "VIDP -> EGLL", 1, 1),
    (TODAY, "VIDP", "VABB", "VIDP -> VABB", 1, 1),
    (TODAY, "XXXX", "VABB", "XXXX -> VABB", 1, 1),
}


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)


def bronze_row(flight):
    _, icao24, first, departure, last, arrival, callsign = flight
    return [icao24, first, departure, last, arrival, callsign] + [""] * 6


def write_lake(root, flights=FLIGHTS):
    """Bronze batches as single files and an airport reference with an extra column."""
    for name in (F0, F1, F2):
        rows = [bronze_row(f) for f in flights if f[0] == name]
        write_csv(f"{root}/bronze/{name}", BRONZE_COLUMNS, rows)
    airports = f"{root}/reference/airports.csv"
    header = ["id"] + [f" {c.upper()}" for c in AIRPORT_COLUMNS]
    write_csv(airports, header, [[i, *a] for i, a in enumerate(AIRPORTS)])
    return airports


def rows(df, drop=()):
    return [tuple(r) for r in df.drop(*drop).collect()]
