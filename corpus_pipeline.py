"""The corpus pipeline: five stages over documents, each stored before the next reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import decontam, langid, mixing, simhash, substring
from flightlake.llm.common import free_name, remainder, shared_folder, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those far from every language's centroids."""
    return langid.keep_identified(docs, langid.fit(docs, remainder("doc_id", 5) != 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words of windows that start earlier elsewhere; documents left without words go."""
    words, removed = (free_name(docs, f"cut_{n}") for n in ("words", "removed"))
    cut = substring.dedup(docs, counts=(words, removed))
    kept = cut.filter((F.col(removed) == 0) | (F.col(removed) < F.col(words)))
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col(removed) > 0, length).otherwise(F.col("n_chars"))
    return kept.select(*[column.alias(c) for c, column in columns.items()])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.keep_clean(docs, decontam.fit(table(spark, sf_dir, "benchmark")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with how many copies of each."""
    quality = mixing.quality_weights(table(spark, sf_dir, "labels"))
    return mixing.mix(docs, quality).filter(F.col("copies") > 0)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_free", benchmark_free),
    ("mixture", mixture),
]

# SQL can't express centroids, fingerprints or BM25 with the same hashes: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written as Parquet to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
