"""Session settings the engine relies on."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import SparkSession

# Needed for right results: dates and hours are UTC dates and hours.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

# Used where neither the submitted configuration nor the session says something else.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}

# Shuffles start from many partitions, which adaptive execution merges where they are small;
# it can't split those of aggregates and windows.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 16
LEAST_PARTITIONS = 200


# Folders are listed by one task each up to this number, which for thousands of small ones costs
# more than the listing.
LISTING_TASKS, LISTING_DEFAULT = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"


def build_session(app_name: str = "flightlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the given settings; defaults only fill what is not set elsewhere.

    A session with a master of its own, as tests and benchmarks have, starts without the web
    page unless asked for.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        conf = {"spark.ui.enabled": "false", **conf}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    told = settings(spark)
    for key, value in DEFAULTS.items():
        if key not in told:
            spark.conf.set(key, value)
    if not told & {INITIAL_PARTITIONS, "spark.sql.shuffle.partitions"}:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(INITIAL_PARTITIONS, max(LEAST_PARTITIONS, PARTITIONS_PER_CORE * cores))
    return prepare(spark)


def settings(spark: SparkSession) -> set[str]:
    """Names of the settings that were made, on submission or in the session."""
    return {row["key"] for row in spark.sql("SET").collect()}


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts from."""
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or plain)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session built by someone else.

    They are made even where they hold already: a value that follows from the machine is no
    setting, and is not sent along with a session's own.
    """
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    if spark.conf.get(LISTING_TASKS) == LISTING_DEFAULT:
        spark.conf.set(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, which `spark.checkpoint.dir` names.

    Only on one machine, as in tests, a temporary one is taken where none is named; executors of
    a cluster would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="shared-")


def parse_day(day: str | dt.date) -> dt.date:
    """Strict YYYY-MM-DD; anything else is an error before any job starts."""
    if isinstance(day, dt.datetime):
        raise ValueError(f"expected a date, got a timestamp: {day!r}")
    if isinstance(day, dt.date):
        return day
    return dt.datetime.strptime(day, "%Y-%m-%d").date()
