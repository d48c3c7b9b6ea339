"""Raw payload files (flat JSON objects) of whole days to bronze batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.schemas import BATCH_SUFFIX, PAYLOAD_SCHEMA, PAYLOAD_TO_BRONZE
from flightlake.session import parse_day
from flightlake.sources.bronze import LINEAGE, ROW_ORDER

# A payload's window is what its file name starts with; parts of a window follow it.
_WINDOW = r"^(flights_\d{4}-\d{2}-\d{2}_\d{2}-\d{2}_to_\d{2}-\d{2})"
# An array per file, which is read as a whole, and one object per line, which can be split.
ARRAYS, LINES = ".json", ".jsonl"


def payload_files(
    spark: SparkSession, payload_dir: str, day: str | dt.date
) -> dict[str, list[str]]:
    """The day's payload files by batch, from a listing. A missing folder is an error."""
    pattern = f"flights_{parse_day(day).isoformat()}_*{{{ARRAYS},{LINES}}}"
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(payload_dir)
    )
    found: dict[str, list[str]] = {}
    names = listed.select(
        "path", F.regexp_extract(F.substring_index("path", "/", -1), _WINDOW, 1).alias("window")
    )
    for row in names.where("window <> ''").collect():
        found.setdefault(row["window"] + BATCH_SUFFIX, []).append(row["path"])
    return found


def read_payload(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """The objects of the files with their batch and row order; a broken file is an error.

    An array is read by one task, however many files there are; files of one object per line
    are split. A file that holds `[]` has no objects. The id of the row order grows along a
    task, so within a block of a file it follows the objects.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(PAYLOAD_SCHEMA).option("mode", "FAILFAST")
    frames = []
    for lines in (False, True):
        some = [p for p in paths if p.endswith(LINES) == lines]
        if some:
            frames.append(_placed(reader.option("multiLine", not lines).json(some)))
    if not frames:
        raise ValueError("no payload files")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _placed(raw: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return raw.select(
        "*",
        F.concat(F.regexp_extract(name, _WINDOW, 1), F.lit(BATCH_SUFFIX)).alias(LINEAGE),
        F.struct(
            name.alias("part"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        ).alias(ROW_ORDER),
    )


def project_payload(payload: DataFrame) -> DataFrame:
    """The payload's fields under their bronze names; fields it lacks are null."""
    have = set(payload.columns)
    return payload.select(
        *[
            (F.col(field) if field in have else F.lit(None)).cast("string").alias(column)
            for field, column in PAYLOAD_TO_BRONZE.items()
        ],
        *[c for c in (LINEAGE, ROW_ORDER) if c in have],
    )


def require_windows(files: dict[str, list[str]], planned: Iterable[str]) -> None:
    """Every planned window has a payload, and no other does."""
    planned = set(planned)
    missing, odd = sorted(planned - set(files)), sorted(set(files) - planned)
    if missing:
        raise ValueError(f"no payload for {missing}; a window without flights is a file with []")
    if odd:
        raise ValueError(f"payload of windows that are not planned: {odd}")

