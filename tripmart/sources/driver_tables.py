"""Raw trips and zones derived from the order tables, so that every rule has rows to act on.

Only integer arithmetic and exact divisions are used; any engine gets the same bits.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import Rules

# Airport zones, run month, run time and file name used with these tables.
DRIVER_RULES = Rules(airport_zone_ids=(5, 13))
DRIVER_YEAR, DRIVER_MONTH, DRIVER_SERVICE = 2026, 1, "yellow"
DRIVER_INGESTED_AT = datetime(2026, 1, 3, 10, 0, 0)
DRIVER_FILE = "lineitem"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("h") % n == 0


def _null_every(n: int, otherwise: Column) -> Column:
    return F.when(~_every(n), otherwise)


def _whole(value: str, divisor: float) -> Column:
    return F.expr(value).cast("double") / divisor


def driver_trips(spark: SparkSession, sf_dir: str, by_order_month: bool = False) -> DataFrame:
    """Raw trip columns plus lineage; one month by default, else the month of the order."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    mixed = "l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 + l_suppkey * 3"
    base = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("h", F.expr(mixed))
        .withColumn("cents", F.expr("(l_partkey * 7 + l_linenumber * 131 + l_orderkey) % 10000 + 250"))
        .withColumn("start", F.col("h") % 86400)
        .withColumn(
            "span",
            F.when(_every(101), 0)
            .when(_every(103), -600)
            .when(_every(107), 90000)
            .when(_every(109), 60)
            .otherwise(600 + F.col("h") % 5400),
        )
        .withColumn("copy", F.explode(F.when(_every(89), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    )

    def at(seconds: str) -> Column:
        return F.expr(f"timestampadd(SECOND, CAST({seconds} AS INT), o_orderdate)")

    year = F.year("o_orderdate") if by_order_month else F.lit(DRIVER_YEAR)
    month = F.month("o_orderdate") if by_order_month else F.lit(DRIVER_MONTH)
    return base.select(
        (1 + F.col("l_linenumber") % 2).cast("bigint").alias("VendorID"),
        _null_every(211, at("start")).alias("tpep_pickup_datetime"),
        _null_every(223, at("start + span")).alias("tpep_dropoff_datetime"),
        F.when(_every(97), -1.0).when(~_every(13), _whole("l_linenumber % 6", 1.0)).alias("passenger_count"),
        F.when(_every(113), -1.0)
        .when(_every(127), F.lit(None))
        .when(_every(53), 0.0)
        .otherwise(F.col("l_quantity") / 4.0)
        .alias("trip_distance"),
        _null_every(41, 1 + F.col("h") % 6).alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.when(_every(131), 999).otherwise(1 + F.col("l_suppkey") % 25).alias("PULocationID"),
        F.when(_every(137), 999).when(~_every(139), 1 + F.col("o_custkey") % 25).alias("DOLocationID"),
        _null_every(43, F.col("h") % 5).alias("payment_type"),
        F.when(_every(151), F.lit(None))
        .when(_every(149), _whole("-cents", 100.0))
        .otherwise(_whole("cents", 100.0))
        .alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        _whole("h % 200", 100.0).alias("tip_amount"),
        F.when(F.col("l_linestatus") == "F", _whole("655", 100.0)).otherwise(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.when(_every(163), F.lit(None))
        .when(_every(157), _whole("-cents", 100.0))
        .otherwise(_whole("cents + 250", 100.0))
        .alias("total_amount"),
        F.lit(0.0).alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
        F.expr("(l_orderkey * 8 + l_linenumber) * 2 + copy").alias("source_row_number"),
        F.lit(DRIVER_SERVICE).alias("service"),
        year.alias("source_year"),
        month.alias("source_month"),
        F.lit(DRIVER_FILE).alias("source_file"),
    )


def driver_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in file form: one zone per nation, its borough the region."""
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    location = F.col("n_nationkey") + 1
    airport = location.isin(list(DRIVER_RULES.airport_zone_ids))
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        location.cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(airport, "Airports").otherwise("Zone").alias("service_zone"),
    )
