"""Gold kept up to date from landed bronze files, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightlake.functions import text
from flightlake.plans import deliveries
from flightlake.schemas import BRONZE_COLUMNS, GOLD_TABLES, LANDED_SCHEMA, GoldTable
from flightlake.session import prepare
from flightlake.sources import bronze, tables

STREAM_SCHEMA = T.StructType(
    [*LANDED_SCHEMA.fields, T.StructField(tables.INGEST_DATE, T.DateType())]
)


def batch_name(batch_id: int) -> str:
    """A micro-batch as a delivery; names are ordered like the ids."""
    return f"{batch_id:012d}"


def read_landed(
    spark: SparkSession, bronze_dir: str, files_per_batch: int | None = None
) -> DataFrame:
    """Landed batches as a stream: every file once, in the order in which they came."""
    reader = spark.readStream.schema(STREAM_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(bronze.landed_path(bronze_dir))


def stream_gold(
    spark: SparkSession,
    lake: deliveries.DeliveryLake,
    lookup: DataFrame,
    gold: Iterable[GoldTable] = GOLD_TABLES,
    files_per_batch: int | None = None,
    interval: str | None = None,
    na_tokens: Iterable[str] = (),
) -> StreamingQuery:
    """Start the stream. It ends when all files that are there have been taken in, unless an
    `interval` between triggers is given.

    Every micro-batch is a delivery named by its id. The checkpoint in the lake says which files
    belong to which batch, so a batch that failed half way is run again with the same files and
    replaces what it had written. Gold holds exact distinct counts, which a streaming aggregate
    can't; so the dates a batch touches are counted anew from all that was delivered. No state is
    kept beside the tables: a flight may come any time after its date, and a record again after
    any time, where a watermark would drop or count them.
    """
    gold, na_tokens = list(gold), list(na_tokens)

    def take(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(
            *[text.null_tokens(F.col(c), na_tokens).alias(c) for c in BRONZE_COLUMNS],
            bronze.LINEAGE,
            bronze.ROW_ORDER,
        )
        deliveries.take(batch.sparkSession, lake, rows, batch_name(batch_id), lookup, gold)

    writer = (
        read_landed(prepare(spark), lake.bronze, files_per_batch)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{lake.root}/checkpoints/stream_gold")
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def catch_up(
    spark: SparkSession,
    lake: deliveries.DeliveryLake,
    lookup: DataFrame,
    gold: Iterable[GoldTable] = GOLD_TABLES,
    files_per_batch: int | None = None,
) -> None:
    """Take in everything that has landed and wait for it; a failed batch is an error."""
    stream_gold(spark, lake, lookup, gold, files_per_batch).awaitTermination()
