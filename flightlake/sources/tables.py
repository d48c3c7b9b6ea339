"""Parquet tables from landing on, each partitioned by a date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.session import parse_day

INGEST_DATE = "ingest_date"
LEAST_TASK_BYTES = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
SMALL_WRITE = "16k"


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files below a file or folder, by listing; none if it is not there."""
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return listed.inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder with files is there, on whatever storage the path names."""
    return bool(files_of(spark, path))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for as long as something runs."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _write(df: DataFrame, path: str, *partition_columns: str) -> None:
    # Only the partitions present in `df` are replaced, and only after all tasks have
    # succeeded, so a lost executor costs a retry. The swap itself is a delete and a rename per
    # file: on a store without atomic renames a driver lost in between leaves a partition that
    # the next run of the date replaces.
    # Files, not bytes, are what a write to many small partitions costs, so its tasks are merged
    # less than others. Rows of one partition stay together all the same.
    with setting(df.sparkSession, LEAST_TASK_BYTES, SMALL_WRITE):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_columns)
            .parquet(path)
        )


def partition_files(
    spark: SparkSession, path: str, columns: Sequence[str], partitions: Iterable[Sequence[str]]
) -> dict[tuple[str, ...], set[str]]:
    """The files of each of the named partitions that is there, by one listing of them all."""
    folders = ["/".join(f"{c}={v}" for c, v in zip(columns, p, strict=True)) for p in partitions]
    if not folders:
        return {}
    return files_by_partition(files_of(spark, f"{path}/{any_of(folders)}"), columns)


def any_of(names: Sequence[str]) -> str:
    """A glob of the names, which those that are not there do not break."""
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def files_by_partition(files: Iterable[str], columns: Sequence[str]) -> dict[tuple[str, ...], set[str]]:
    found: dict[tuple[str, ...], set[str]] = {}
    for file in files:
        values = dict(part.split("=", 1) for part in file.split("/") if "=" in part)
        found.setdefault(tuple(values[c] for c in columns), set()).add(file)
    return found


def replace_partitions(
    df: DataFrame, path: str, columns: Sequence[str], partitions: Iterable[Sequence[str]]
) -> None:
    """Write `df` so that each of the named partitions ends with exactly its rows in `df`, and so
    does every other partition that `df` has rows of."""
    partitions = [tuple(map(str, values)) for values in partitions]
    there = partition_files(df.sparkSession, path, columns, partitions)
    replace_files(df, path, columns, {p: there.get(p, set()) for p in partitions})


def replace_files(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    before: Mapping[tuple[str, ...], set[str]],
) -> None:
    """The same for partitions whose files are known.

    A dynamic overwrite leaves partitions alone for which there are no rows. Those are known by
    their files, which are still the old ones, and are then replaced by an empty file. So the
    frame is computed once, and no partition is deleted before its rows are written.
    """
    spark = df.sparkSession
    _write(df, path, *columns)
    after = partition_files(spark, path, columns, before)
    nothing = spark.createDataFrame([], df.drop(*columns).schema)
    for values, files in before.items():
        if after.get(values, set()) == files:
            folder = "/".join(f"{c}={v}" for c, v in zip(columns, values, strict=True))
            nothing.coalesce(1).write.mode("overwrite").parquet(f"{path}/{folder}")


def write_day(df: DataFrame, path: str, day: str | dt.date) -> None:
    """Replace one ingestion date of a flight-level table, keeping the frame's partitioning."""
    day = parse_day(day)
    dated = df.withColumn(INGEST_DATE, F.lit(day))
    replace_partitions(dated, path, [INGEST_DATE], [(day.isoformat(),)])


def read_partition(spark, path: str, schema: T.StructType, column: str, day) -> DataFrame:
    """One date of a table. Only its own folder is listed, however many dates the table has;
    a missing table or date is an error."""
    fields = [f for f in schema if f.name != column] + [T.StructField(column, T.DateType())]
    return (
        spark.read.schema(T.StructType(fields))
        .option("basePath", path)
        .parquet(f"{path}/{column}={parse_day(day).isoformat()}")
        .select(*schema.names)
    )


def read_day(spark: SparkSession, path: str, schema: T.StructType, day: str | dt.date) -> DataFrame:
    """One ingestion date of a flight-level table."""
    return read_partition(spark, path, schema, INGEST_DATE, day)


def _compacted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """A date's rows together and sorted, so that a write of many dates does not leave one
    small file per task and date; adaptive execution splits a date too large for one task."""
    compact = df.hint("rebalance", F.col("flight_date"))
    return compact.sortWithinPartitions("flight_date", *order)


def write_dated(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Replace the flight dates present in `df`, each date sorted by `order`."""
    _write(_compacted(df, order), path, "flight_date")


def write_date(df: DataFrame, path: str, day: str | dt.date, order: Sequence[Column]) -> None:
    """Replace one flight date, by nothing if `df` has no rows of it."""
    day = parse_day(day)
    of_day = df.where(F.col("flight_date") == F.lit(day))
    replace_partitions(_compacted(of_day, order), path, ["flight_date"], [(day.isoformat(),)])


def write_dates(
    df: DataFrame, path: str, days: Sequence[str | dt.date], order: Sequence[Column]
) -> None:
    """Replace the given flight dates, which are all that `df` has rows of; those that were there
    and have no rows any more end empty."""
    named = [(parse_day(day).isoformat(),) for day in days]
    there = partition_files(df.sparkSession, path, ["flight_date"], named)
    replace_files(_compacted(df, order), path, ["flight_date"], there)


def read_dates(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str | dt.date]
) -> DataFrame:
    """The given flight dates of a table; only their own folders are listed. Dates without a
    folder have no rows."""
    fields = [f for f in schema if f.name != "flight_date"]
    dated = T.StructType([*fields, T.StructField("flight_date", T.DateType())])
    reader = spark.read.schema(dated).option("basePath", path)
    folders = [f"flight_date={parse_day(day).isoformat()}" for day in days]
    try:
        return reader.parquet(f"{path}/{any_of(folders)}").select(*schema.names)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_date(spark: SparkSession, path: str, schema: T.StructType, day: str | dt.date) -> DataFrame:
    """One flight date of a gold table."""
    return read_partition(spark, path, schema, "flight_date", day)
