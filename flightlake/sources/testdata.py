"""Flights and airports derived from the star-schema test tables.

Airports are nations and countries are regions. The derivation plants what raw flight data
suffers from: padding, mixed case, blanks, malformed numbers, negative distances, times out
of order, duplicate deliveries, duplicate and missing airport codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.schemas import AIRPORT_COLUMNS, BRONZE_COLUMNS
from flightlake.sources.bronze import LINEAGE, ROW_ORDER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def leaves_cores_idle(scan: DataFrame) -> bool:
    """Whether a scan has fewer splits than there are cores, as a small file has."""
    return scan.rdd.getNumPartitions() < scan.sparkSession.sparkContext.defaultParallelism


def _text(c: Column) -> Column:
    return c.cast("string")


def _day_seconds(ts: str) -> Column:
    return F.unix_date(F.to_date(ts)).cast("long") * 86400


def bronze_flights(spark: SparkSession, sf_dir: str, batch: str | None = None) -> DataFrame:
    """Bronze columns plus lineage and row order, of both deliveries or of the one named.

    Customers join the orders before the far larger lines do, so lines are shuffled once, by
    order. The second delivery of a line is made by exploding it after the joins, so every
    table is scanned and joined once; alone, it takes only its own lines through the joins. The lines of a file with fewer splits than there are cores
    are dealt out before the joins, so that cleaning uses every core; a large table never is.
    """
    nation = table(spark, sf_dir, "nation")
    supplier_nation = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("supplier_nation"))
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderdate", F.col("n_name").alias("customer_nation"))
    )
    lines = table(spark, sf_dir, "lineitem")
    if leaves_cores_idle(lines):
        cores = spark.sparkContext.defaultParallelism
        lines = lines.repartition(cores, "l_orderkey", "l_linenumber")
    if batch == "b":
        lines = lines.where(F.col("l_linenumber") == 3)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        supplier_nation, F.col("l_suppkey") == F.col("s_suppkey")
    )
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    heavy = F.col("l_quantity") > 45
    twice = F.array(F.lit("a"), F.lit("b"))
    once = F.array(F.lit("a"))
    delivered = joined.withColumn(
        "batch",
        F.explode(F.when(line == 3, twice).otherwise(once)) if batch is None else F.lit(batch),
    )
    columns = {
        "icao24": F.concat(F.lit(" ac"), F.lpad(_text(F.col("l_suppkey")), 6, "0"), F.lit(" ")),
        "first_seen": _text(_day_seconds("o_orderdate") + line * 5400),
        "departure_airport": F.when(
            (F.col("l_returnflag") == "R") & (line == 1), F.lit("  ")
        ).otherwise(F.lower("supplier_nation")),
        "last_seen": _text(_day_seconds("l_shipdate") + line * 7200),
        "arrival_airport": F.when(
            ~((F.col("l_returnflag") == "N") & (line == 2)),
            F.concat(F.lit(" "), F.col("customer_nation")),
        ),
        "callsign": F.when(line == 7, F.lit("")).otherwise(
            F.concat(F.lit("cs"), _text(F.col("o_orderkey")), F.col("batch"))
        ),
        "departure_airport_horiz_distance": F.when((line == 4) & heavy, F.lit("bad")).otherwise(
            _text(quantity - 5)
        ),
        "departure_airport_vert_distance": F.when((line == 5) & heavy, F.lit("1d")).otherwise(
            _text(quantity - 10)
        ),
        "arrival_airport_horiz_distance": F.when((line == 6) & heavy, F.lit("NaN")).otherwise(
            _text(quantity - 3)
        ),
        "arrival_airport_vert_distance": F.when((line == 2) & heavy, F.lit("inf")).otherwise(
            F.concat(F.lit(" "), _text(quantity - 20), F.lit(".5"))
        ),
        "departure_airport_candidates": _text(line),
        "arrival_airport_candidates": F.when(line != 1, _text(line % 3)),
    }
    return delivered.select(
        *[columns[c].alias(c) for c in BRONZE_COLUMNS],
        F.col("batch").alias(LINEAGE),
        F.struct("o_orderkey", "l_linenumber", "l_partkey").alias(ROW_ORDER),
    )


def airport_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    copies = F.when(F.col("n_nationkey") == 1, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    nations = nations.withColumn("copy", F.explode(copies))
    columns = {
        "ident": F.col("n_name"),
        "name": F.concat(
            F.col("n_name"),
            F.lit(" Airport"),
            F.when(F.col("copy") == 1, F.lit(" copy")).otherwise(F.lit("")),
        ),
        "iso_country": F.lower("r_name"),
        "icao_code": F.when(
            F.col("n_nationkey") % 8 != 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))
        ),
        "iata_code": F.concat(F.lit("N"), _text(F.col("n_nationkey"))),
    }
    return nations.select(
        *[columns[c].alias(c) for c in AIRPORT_COLUMNS],
        (F.col("n_nationkey") * 10 + F.col("copy")).alias(ROW_ORDER),
    )
