import datetime as dt
import glob
import os

import pytest

from flightlake.operators import history, traffic
from flightlake.schemas import AIRPORT_TRAFFIC, ROUTE_TRAFFIC

D1, D2, D3 = (dt.date(2026, 9, d) for d in (25, 26, 27))


def airport(date, code, total, country="X"):
    return (date, code, country, total, 1, 0, 0, total, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, AIRPORT_TRAFFIC.schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


OLD = [airport(D1, "A", 5), airport(D1, "B", 9), airport(D2, "A", 3), airport(D3, "C", 1)]
NEW = [airport(D2, "A", 7), airport(D2, "B", 2)]


def files(path, date):
    found = glob.glob(f"{path}/flight_date={date}/*.parquet")
    return {(f, os.stat(f).st_mtime_ns) for f in found}


def test_replace_date(spark):
    found = history.replace_date(frame(spark, OLD), frame(spark, NEW), D2, AIRPORT_TRAFFIC)
    assert rows(found) == sorted([r for r in OLD if r[0] != D2] + NEW)
    again = history.replace_date(found, frame(spark, NEW), D2, AIRPORT_TRAFFIC)
    assert rows(again) == rows(found)


def test_rows_without_a_date_survive_a_replacement(spark):
    old = OLD + [airport(None, "Q", 1)]
    found = history.replace_date(frame(spark, old), frame(spark, NEW), D2, AIRPORT_TRAFFIC)
    assert found.where("flight_date is null").count() == 1


def test_stored_replacement_touches_one_date(spark, folder):
    path = f"{folder}/gold"
    history.write_gold(frame(spark, OLD), path, AIRPORT_TRAFFIC)
    before = {d: files(path, d) for d in (D1, D2, D3)}
    history.write_gold_day(frame(spark, NEW + OLD), path, D2, AIRPORT_TRAFFIC)
    after = {d: files(path, d) for d in (D1, D2, D3)}
    assert before[D1] == after[D1] and before[D3] == after[D3] and before[D2] != after[D2]
    stored = history.read_gold(spark, path, AIRPORT_TRAFFIC)
    assert rows(stored.where(stored.flight_date == D2)) == sorted(NEW + [OLD[2]])


def test_stored_dates_are_sorted_by_metric(spark, folder):
    path = f"{folder}/gold"
    busy = [airport(D1, f"A{i:02}", i % 7) for i in range(40)]
    history.write_gold(frame(spark, busy).repartition(6), path, AIRPORT_TRAFFIC)
    (file,) = glob.glob(f"{path}/flight_date={D1}/*.parquet")
    found = [(r["total_traffic"], r["airport"]) for r in spark.read.parquet(file).collect()]
    assert found == sorted(found, key=lambda r: (-r[0], r[1]))


def test_history_sorted(spark):
    found = history.history_sorted(frame(spark, OLD + NEW[1:]), AIRPORT_TRAFFIC).collect()
    assert [(r["flight_date"], r["airport"]) for r in found] == [
        (D1, "B"),
        (D1, "A"),
        (D2, "A"),
        (D2, "B"),
        (D3, "C"),
    ]


def test_upsert(spark):
    batch = [airport(D2, "A", 8, country="Z"), airport(D2, "N", 1)]
    found = history.upsert(frame(spark, OLD), frame(spark, batch), AIRPORT_TRAFFIC.key)
    expected = sorted([r for r in OLD if r[:2] != (D2, "A")] + batch)
    assert rows(found) == expected
    again = history.upsert(found, frame(spark, batch), AIRPORT_TRAFFIC.key)
    assert rows(again) == expected


def test_stored_upsert(spark, folder):
    path = f"{folder}/warehouse"
    history.upsert_gold(spark, frame(spark, OLD), path, AIRPORT_TRAFFIC)
    before = {d: files(path, d) for d in (D1, D2, D3)}
    # D1 and D3 are touched, D2 lies between them and is not.
    batch = [airport(D1, "A", 6), airport(D3, "D", 4)]
    for _ in range(2):
        history.upsert_gold(spark, frame(spark, batch), path, AIRPORT_TRAFFIC)
        stored = history.read_gold(spark, path, AIRPORT_TRAFFIC)
        assert rows(stored) == sorted([r for r in OLD if r[:2] != (D1, "A")] + batch)
    assert files(path, D2) == before[D2] and files(path, D1) != before[D1]


def test_upsert_of_nothing(spark, folder):
    path = f"{folder}/warehouse"
    history.upsert_gold(spark, frame(spark, OLD), path, AIRPORT_TRAFFIC)
    history.upsert_gold(spark, frame(spark, []), path, AIRPORT_TRAFFIC)
    assert rows(history.read_gold(spark, path, AIRPORT_TRAFFIC)) == sorted(OLD)


def test_batch_with_a_repeated_key_is_refused(spark, folder):
    batch = [airport(D2, "A", 1, "X"), airport(D2, "A", 1, "Y")]
    with pytest.raises(ValueError, match="one key"):
        history.upsert_gold(spark, frame(spark, batch), f"{folder}/w", AIRPORT_TRAFFIC)
    assert not os.path.exists(f"{folder}/w")


def test_schema_is_enforced(spark):
    older = frame(spark, OLD).selectExpr("'x' as obsolete", "*").select(
        "obsolete", *reversed(AIRPORT_TRAFFIC.schema.names)
    )
    assert traffic.enforce_schema(older, AIRPORT_TRAFFIC.schema).columns == AIRPORT_TRAFFIC.schema.names
    with pytest.raises(Exception, match="route"):
        traffic.enforce_schema(older, ROUTE_TRAFFIC.schema)


def test_textual_dates_are_coerced(spark):
    df = spark.createDataFrame([("2026-09-27",), ("soon",), (None,)], "flight_date string")
    found = [r[0] for r in traffic.coerce_flight_date(df).collect()]
    assert found == [D3, None, None]
    assert traffic.filter_date(traffic.coerce_flight_date(df), "2026-09-27").count() == 1


def test_bucketed_upsert_equals_the_plain_one(spark, folder):
    path = f"{folder}/target"
    history.upsert_bucketed(spark, frame(spark, OLD), path, AIRPORT_TRAFFIC, 4)
    assert rows(history.read_bucketed(spark, path, AIRPORT_TRAFFIC, 4)) == sorted(OLD)
    before = {d: files(path, d) for d in (D1, D3)}
    for _ in range(2):
        history.upsert_bucketed(spark, frame(spark, NEW), path, AIRPORT_TRAFFIC, 4)
        want = history.upsert(frame(spark, OLD), frame(spark, NEW), AIRPORT_TRAFFIC.key)
        assert rows(history.read_bucketed(spark, path, AIRPORT_TRAFFIC, 4)) == rows(want)
    assert {d: files(path, d) for d in (D1, D3)} == before
    # Another session finds the table by its files.
    spark.sql(f"DROP TABLE {history.bucketed(spark, path, AIRPORT_TRAFFIC, 4)}")
    assert rows(history.read_bucketed(spark, path, AIRPORT_TRAFFIC, 4)) == rows(want)
    with pytest.raises(ValueError, match="several rows"):
        history.upsert_bucketed(spark, frame(spark, NEW + NEW), path, AIRPORT_TRAFFIC, 4)


def test_the_bucketed_target_is_not_shuffled(spark, folder):
    path = f"{folder}/target"
    many = [airport(D1, f"A{i}", i) for i in range(500)]
    history.upsert_bucketed(spark, frame(spark, many), path, AIRPORT_TRAFFIC, 4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", history.ALL_KEYS)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set(history.ALL_KEYS, "false")
    try:
        batch = frame(spark, many[::2] + [airport(D1, "new", 1)])
        result = history.bucketed_upsert(spark, batch, path, AIRPORT_TRAFFIC, 4)
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    scan = plan.index("FileScan parquet")
    join = plan.index("LeftAnti")
    assert "Exchange" not in plan[join:scan]
    assert plan.count("Exchange hashpartitioning") == 1
