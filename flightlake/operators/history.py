"""Keeping gold history: replace one date, or upsert by key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.traffic import enforce_schema
from flightlake.schemas import GoldTable
from flightlake.session import parse_day
from flightlake.sources.tables import (
    exists,
    read_date,
    read_dated,
    setting,
    write_date,
    write_dated,
)


def ranking_order(table: GoldTable) -> list[Column]:
    """Busiest first, ties by key."""
    return [F.desc(table.metric)] + [F.asc(k) for k in table.key if k != "flight_date"]


def history_sorted(gold: DataFrame, table: GoldTable) -> DataFrame:
    return gold.orderBy(F.asc("flight_date"), *ranking_order(table))


def replace_date(history: DataFrame, fresh: DataFrame, day, table: GoldTable) -> DataFrame:
    """History with the rows of `day` exchanged for the fresh ones."""
    day = F.lit(parse_day(day))
    kept = history.where(~F.col("flight_date").eqNullSafe(day))
    renewed = fresh.where(F.col("flight_date") == day)
    return enforce_schema(kept, table.schema).unionByName(enforce_schema(renewed, table.schema))


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch lacks, and the whole batch."""
    return target.join(batch.select(*key), list(key), "left_anti").unionByName(batch)


def require_unique(batch: DataFrame, key: Sequence[str]) -> None:
    repeated = batch.groupBy(*key).count().where(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"batch holds several rows for one key {list(key)}")


# Stored form ------------------------------------------------------------------------------


def write_gold(gold: DataFrame, path: str, table: GoldTable) -> None:
    """Replace exactly the dates in `gold`; other dates' partitions are not touched."""
    write_dated(enforce_schema(gold, table.schema), path, ranking_order(table))


def read_gold(spark: SparkSession, path: str, table: GoldTable) -> DataFrame:
    return read_dated(spark, path, table.schema)


def read_gold_day(spark: SparkSession, path: str, day, table: GoldTable) -> DataFrame:
    return read_date(spark, path, table.schema, day)


def write_gold_day(gold: DataFrame, path: str, day: str | dt.date, table: GoldTable) -> None:
    """Replace one date by its rows in `gold`, none included."""
    write_date(enforce_schema(gold, table.schema), path, day, ranking_order(table))


def upsert_gold(spark: SparkSession, batch: DataFrame, path: str, table: GoldTable) -> None:
    """Upsert a batch into the stored table, rewriting only the dates the batch touches.

    The key contains the date, so the other dates cannot conflict and are not even read. The
    new partitions are staged and swapped in at the end, which is why reading and replacing
    the same table is safe here. Running the batch again gives the same table. The batch is
    computed several times (unique keys, dates, both sides of the join), so it should be a
    stored one, as gold is.
    """
    batch = enforce_schema(batch, table.schema)
    require_unique(batch, table.key)
    if not exists(spark, path):
        return write_gold(batch, path, table)
    span = batch.agg(F.min("flight_date").alias("first"), F.max("flight_date").alias("last"))
    span = span.first()
    if span["first"] is None:
        return None
    touched = (
        read_gold(spark, path, table)
        .where(F.col("flight_date").between(F.lit(span["first"]), F.lit(span["last"])))
        .join(batch.select("flight_date").distinct(), "flight_date", "left_semi")
    )
    return write_gold(upsert(touched, batch, table.key), path, table)


# Bucketed form ----------------------------------------------------------------------------

# Buckets of one date. A date of a gold table has at most a row per airport pair.
BUCKETS = 16
# A target hashed by a part of the key need not be hashed again by all of it.
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def bucketed(spark: SparkSession, path: str, table: GoldTable, buckets: int = BUCKETS) -> str:
    """The name under which a bucketed target below `path` is known to the session.

    It is partitioned by date, like other gold tables, and within a date hashed and sorted by the
    rest of the key. Only the description is the session's; files stay where they are, and their
    dates are looked up when a session first asks.
    """
    name = f"{table.name}_{sha256(f'{path}:{buckets}'.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        keys = ", ".join(f"`{k}`" for k in table.key if k != "flight_date")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (flight_date)"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
            f" LOCATION '{path}'"
        )
        if exists(spark, path):
            spark.catalog.recoverPartitions(name)
    return name


def bucketed_upsert(
    spark: SparkSession, batch: DataFrame, path: str, table: GoldTable, buckets: int = BUCKETS
) -> DataFrame:
    """The rows of the batch's dates after an upsert. The target's buckets are read side by side
    with the batch, which alone is shuffled, into as many partitions."""
    name = bucketed(spark, path, table, buckets)
    days = [r["flight_date"] for r in batch.select("flight_date").distinct().collect()]
    target = spark.table(name).where(F.col("flight_date").isin(days))
    return upsert(target.select(*table.schema.names), batch, table.key)


def upsert_bucketed(
    spark: SparkSession, batch: DataFrame, path: str, table: GoldTable, buckets: int = BUCKETS
) -> None:
    """Upsert a batch into a bucketed target, rewriting only the dates the batch touches.

    As for `upsert_gold`, the batch should be a stored one. A target that is not there yet is
    made. What is kept of the target stays in its buckets on the way from scan to write.
    """
    batch = enforce_schema(batch, table.schema)
    require_unique(batch, table.key)
    name = bucketed(spark, path, table, buckets)
    # An insert into a named table takes its mode from the session.
    with setting(spark, ALL_KEYS, "false"), setting(spark, OVERWRITE_MODE, "dynamic"):
        rows = bucketed_upsert(spark, batch, path, table, buckets)
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def read_bucketed(
    spark: SparkSession, path: str, table: GoldTable, buckets: int = BUCKETS
) -> DataFrame:
    return spark.table(bucketed(spark, path, table, buckets)).select(*table.schema.names)
