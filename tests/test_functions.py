import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.functions import numeric, text, times
from flightlake.session import parse_day

SETTINGS = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

padding = st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0   　", max_size=3)
padded = st.builds(lambda a, b, c: a + b + c, padding, st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=6), padding)


def column(spark, values, kind="string"):
    schema = f"id int, v {kind}"
    return spark.createDataFrame(list(enumerate(values)), schema).coalesce(1)


def apply(spark, values, build, kind="string"):
    found = column(spark, values, kind).select("id", build(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(found, key=lambda r: r["id"])]


@SETTINGS
@given(st.lists(st.none() | padded, min_size=1, max_size=20))
def test_strip_and_blank(spark, values):
    assert apply(spark, values, text.strip) == [v if v is None else v.strip() for v in values]
    assert apply(spark, values, text.blank_to_null) == [
        v if v is not None and v.strip() else None for v in values
    ]


def test_code_form(spark):
    values = [" 4ca1fa ", "\tvidp\xa0", "   ", "", None, "\x1cabc　"]
    expected = ["4CA1FA", "VIDP", None, None, None, "ABC"]
    assert apply(spark, values, text.code) == expected


NUMBERS = [
    "12",
    " 12.5 ",
    "-3",
    "+4",
    "1e3",
    "1E-2",
    ".5",
    "5.",
    "",
    "   ",
    None,
    "bad",
    "1d",
    "1f",
    "0x10",
    "0x1p3",
    "1,000",
    "1 2",
    "--1",
    "e5",
    ".",
    "-",
]


def test_lenient_numbers_follow_pandas(spark):
    expected = pd.to_numeric(pd.Series(NUMBERS, dtype=object), errors="coerce")
    expected = [None if np.isnan(x) else float(x) for x in expected]
    # pandas reads hex integers, which no number column of a flight feed contains.
    expected[NUMBERS.index("0x10")] = None
    assert apply(spark, NUMBERS, numeric.to_double) == expected


def test_no_nan_and_no_infinity(spark):
    values = ["NaN", "nan", "inf", "-inf", "Infinity", "1e999", "-1e999", "7"]
    assert apply(spark, values, numeric.to_double) == [None] * 7 + [7.0]
    doubles = [float("nan"), 1.0, None, float("inf")]
    assert apply(spark, doubles, numeric.nan_to_null, "double") == [None, 1.0, None, float("inf")]
    doubles = [-float("inf"), 1.0, None, float("inf")]
    assert apply(spark, doubles, numeric.infinity_to_null, "double") == [None, 1.0, None, None]


def test_non_negative(spark):
    assert apply(spark, [-1.0, 0.0, 2.0, None], numeric.non_negative, "double") == [
        None,
        0.0,
        2.0,
        None,
    ]


@SETTINGS
@given(st.lists(st.integers(-(10**9), 9 * 10**9), min_size=1, max_size=20))
def test_epochs(spark, seconds):
    build = lambda c: F.unix_micros(times.epoch_to_timestamp(c))
    found = apply(spark, [float(s) for s in seconds], build, "double")
    assert found == [s * 10**6 for s in seconds]


def test_epoch_range(spark):
    edge = times.MAX_EPOCH_SECONDS
    values = [float(edge), float(edge + 1), -float(edge), -float(edge + 1), 1e300, None]
    known = apply(spark, values, lambda c: times.epoch_to_timestamp(c).isNotNull(), "double")
    assert known == [True, False, True, False, False, False]
    stamps = pd.to_datetime(pd.Series(values[:2]), unit="s", utc=True, errors="coerce")
    assert list(stamps.notna()) == known[:2]


def windows_of(spark, now):
    row = (
        spark.createDataFrame([(now,)], "now string")
        .select(F.col("now").cast("timestamp").alias("now"))
        .select(
            *[c.cast("string") for c in times.last_hour_window(F.col("now"))],
            *[c.cast("string") for c in times.day_window(F.to_date("now"))],
            times.previous_day(F.col("now")).cast("string"),
        )
        .first()
    )
    return tuple(row)


def test_windows(spark):
    assert windows_of(spark, "2026-03-01 00:59:59") == (
        "2026-02-28 23:00:00",
        "2026-03-01 00:00:00",
        "2026-03-01 00:00:00",
        "2026-03-02 00:00:00",
        "2026-02-28",
    )


@pytest.mark.parametrize("hours", [1, 2, 5, 7, 24])
def test_day_is_cut_into_windows_that_cover_it(spark, hours):
    from flightlake.plans import windows

    days = spark.createDataFrame([(dt.date(2026, 9, 27),)], "day date")
    plan = windows.backfill_plan(days, "day", hours).orderBy("window_number").collect()
    start, expected = dt.datetime(2026, 9, 27), []
    while start < dt.datetime(2026, 9, 28):
        end = min(start + dt.timedelta(hours=hours), dt.datetime(2026, 9, 28))
        expected.append((start, end, times.window_label_of(start, end)))
        start = end
    found = [(r["window_start"], r["window_end"], r["bronze_file"]) for r in plan]
    assert found == expected
    assert [r["window_number"] for r in plan] == list(range(1, len(plan) + 1))


def test_hourly_window_on_the_driver():
    from flightlake.plans import windows

    east = dt.timezone(dt.timedelta(hours=5, minutes=30))
    start, end = windows.hourly_window(dt.datetime(2026, 9, 27, 5, 45, tzinfo=east))
    assert (start, end) == (
        dt.datetime(2026, 9, 26, 23, tzinfo=dt.timezone.utc),
        dt.datetime(2026, 9, 27, 0, tzinfo=dt.timezone.utc),
    )


def test_parse_day():
    assert parse_day("2026-09-27") == dt.date(2026, 9, 27)
    assert parse_day(dt.date(2026, 9, 27)) == dt.date(2026, 9, 27)
    for bad in ("27-09-2026", "2026-09-31", "", "2026-09-27 00:00"):
        with pytest.raises(ValueError):
            parse_day(bad)
    with pytest.raises(ValueError):
        parse_day(dt.datetime(2026, 9, 27))


def test_normalize_header():
    assert text.normalize_header("  First Seen ") == "first_seen"
