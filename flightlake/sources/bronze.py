"""Bronze scan: every batch of one ingestion date, with lineage and a stable row order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions import text
from flightlake.schemas import BRONZE_COLUMNS, CSV_FORMAT, LANDED_SCHEMA
from flightlake.session import parse_day
from flightlake.sources import tables

LINEAGE = "bronze_file"
ROW_ORDER = "row_order"
# Headers read at the same time.
PROBES_AT_ONCE = 8


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.normalize_header(c) for c in df.columns])


def batch_and_part(name: Column, path: Column) -> tuple[Column, Column]:
    """The batch a file belongs to, which is the file itself or the folder Spark wrote it in,
    and the file's name inside such a folder. Computed per row, hence without patterns."""
    is_batch = name.startswith("flights_")
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(is_batch, name).otherwise(folder), F.when(~is_batch, name)


def batch_glob(bronze_dir: str, day: str | dt.date) -> str:
    return f"{bronze_dir.rstrip('/')}/flights_{parse_day(day).isoformat()}_*.csv"


def landed_path(bronze_dir: str) -> str:
    """Where landed batches are stored, by ingestion date and batch."""
    return f"{bronze_dir.rstrip('/')}/landed"


def write_landed(
    batches: DataFrame, bronze_dir: str, day: str | dt.date, names: Iterable[str]
) -> None:
    """Replace the named batches of a date, all in one job; those without rows become empty.

    Parquet keeps every text as it is, line breaks and padding included.
    """
    day = parse_day(day)
    dated = batches.withColumn(tables.INGEST_DATE, F.lit(day)).select(
        *BRONZE_COLUMNS, ROW_ORDER, tables.INGEST_DATE, LINEAGE
    )
    tables.replace_partitions(
        dated,
        landed_path(bronze_dir),
        [tables.INGEST_DATE, LINEAGE],
        [(day.isoformat(), name) for name in names],
    )


def _read_landed(spark: SparkSession, bronze_dir: str, day: str | dt.date) -> DataFrame:
    return tables.read_partition(
        spark, landed_path(bronze_dir), LANDED_SCHEMA, tables.INGEST_DATE, day
    ).select(*BRONZE_COLUMNS, LINEAGE, ROW_ORDER)


def csv_headers(spark: SparkSession, paths: str) -> dict[str, list[str]]:
    """The files by their header line, of which each file's first block gives one.

    A file's probe is a job of one task that ends with the first line, so of each file only the
    beginning is read, however large it is. Files are probed side by side; a date has one for
    each window, or one for each part of a window.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path").collect()
    files = sorted(row["path"] for row in listed)

    def header(path: str) -> str | None:
        lines = spark.read.text(path).where("_metadata.file_block_start = 0")
        first = lines.select("value").first()
        return None if first is None else first["value"].removeprefix("\ufeff")

    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(PROBES_AT_ONCE) as probes:
        for path, line in zip(files, probes.map(inheritable_thread_target(spark)(header), files), strict=True):
            if line is not None:
                found.setdefault(line, []).append(path)
    return found


def _read_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one header. A row with fewer or more fields than the header is an error, and
    stays one when only some columns are asked for."""
    raw = (
        spark.read.options(**CSV_FORMAT)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(paths)
    )
    batch, part = batch_and_part(F.col("_metadata.file_name"), F.col("_metadata.file_path"))
    return normalize_headers(
        raw.select(
            "*",
            batch.alias(LINEAGE),
            F.struct(
                part.alias("part"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("id"),
            ).alias(ROW_ORDER),
        )
    )


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Bronze frames one after the other, columns matched by name, missing ones null."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    have = set(both.columns)
    return both.select(
        *[c if c in have else F.lit(None).cast("string").alias(c) for c in BRONZE_COLUMNS],
        LINEAGE,
        ROW_ORDER,
    )


def read_bronze(
    spark: SparkSession,
    bronze_dir: str,
    day: str | dt.date,
    na_tokens: Iterable[str] = (),
) -> DataFrame:
    """All batches of `day`, as text, plus `bronze_file` and `row_order`.

    Batches are either landed (Parquet) or CSV files delivered ready, of which those named like
    a landed one are older deliveries and left out. One scan reads all landed batches and one
    all CSV files of the same header; files whose header has other columns, or others first, are
    united by column name. No batch for the day is an error (PATH_NOT_FOUND).

    `row_order` is (part, block, id). The part names the file inside a batch that is a folder
    and is null for a batch that is a file, which spares the shuffle a second long name. The
    id grows along a scan task, so within a block it follows the lines; a retried task yields
    the same ids again.
    """
    frames, landed = [], set()
    try:
        frames.append(_read_landed(spark, bronze_dir, day))
        folder = f"{landed_path(bronze_dir)}/{tables.INGEST_DATE}={parse_day(day).isoformat()}"
        mark = f"{LINEAGE}="
        landed = {
            part.removeprefix(mark)
            for file in tables.files_of(spark, folder)
            for part in file.split("/")
            if part.startswith(mark)
        }
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    try:
        headers = csv_headers(spark, batch_glob(bronze_dir, day))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND" or not frames:
            raise
        headers = {}
    for paths in headers.values():
        ready = [p for p in paths if not landed & set(p.split("/")[-2:])]
        if ready:
            frames.append(_read_csv(spark, ready))
    return union_by_name(frames).select(
        *[text.null_tokens(F.col(c), na_tokens).alias(c) for c in BRONZE_COLUMNS],
        LINEAGE,
        ROW_ORDER,
    )


def batch_counts(bronze: DataFrame) -> DataFrame:
    """Rows per batch."""
    return bronze.groupBy(LINEAGE).agg(F.count("*").alias("row_count"))


def batch_totals(bronze: DataFrame) -> DataFrame:
    """Batches and rows over everything read."""
    return batch_counts(bronze).agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
    )
