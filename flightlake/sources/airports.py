"""Airport reference."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions import text
from flightlake.schemas import AIRPORT_COLUMNS, CSV_FORMAT
from flightlake.sources.bronze import ROW_ORDER, normalize_headers


def read_airports(spark: SparkSession, path: str, na_tokens: Iterable[str] = ()) -> DataFrame:
    """The five columns used, plus the row order that decides between duplicate codes.

    A missing column is an error. Namibia's code `NA` stays a value unless `na_tokens`
    names it.
    """
    # The reference is one small file; names may hold quotes, commas and line breaks.
    raw = spark.read.options(**CSV_FORMAT).options(enforceSchema=False, multiLine=True).csv(path)
    order = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    raw = normalize_headers(raw.select("*", order.alias(ROW_ORDER)))
    return raw.select(
        *[text.null_tokens(F.col(c), na_tokens).alias(c) for c in AIRPORT_COLUMNS], ROW_ORDER
    )
