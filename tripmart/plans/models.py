"""Staging models, dimensions, the trip fact and the anomaly mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import Rules
from tripmart.functions.trip import touches
from tripmart.sources.schema import CLASSIFIED_SCHEMA

# Payment and rate code labels, and the last hour of each part of the day.
PAYMENT_TYPES = [
    (0, "Unknown"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES = [
    (0, "Unknown"),
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]
DAY_PARTS = {"morning": (5, 11), "afternoon": (12, 16), "evening": (17, 20)}
OTHER_DAY_PART = "overnight"

FACT_COLUMNS = (
    "trip_id",
    "service",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "pickup_zone_id",
    "dropoff_zone_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "payment_type",
    "rate_code_id",
    "duration_minutes",
    "average_speed_mph",
    "revenue_per_mile",
    "is_airport_trip",
    "quality_status",
    "quality_reasons",
    "source_file",
    "ingested_at",
)


def stg_trips(staged: DataFrame) -> DataFrame:
    """Staged trips with contract types; unknown rate and payment codes become 0."""
    defaulted = {"rate_code_id", "payment_type"}

    def column(name: str, kind) -> Column:
        value = F.col(name).cast(kind)
        return (F.coalesce(value, F.lit(0)) if name in defaulted else value).alias(name)

    return staged.select(*[column(f.name, f.dataType) for f in CLASSIFIED_SCHEMA.fields])


def stg_zones(zones: DataFrame) -> DataFrame:
    text = [F.col(name).cast("string") for name in ("borough", "zone_name", "service_zone")]
    return zones.select(F.col("location_id").cast("int").alias("zone_id"), *text)


def with_pickup_clock(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "pickup_date": F.col("pickup_datetime").cast("date"),
            "pickup_hour": F.hour("pickup_datetime"),
        }
    )


def fct_trips(stg: DataFrame) -> DataFrame:
    """One row per loadable trip. A projection of staging: the rows are stored once."""
    return with_pickup_clock(stg).select(*FACT_COLUMNS)


def dim_zone(stg: DataFrame, rules: Rules) -> DataFrame:
    return stg.select(
        "zone_id",
        "borough",
        "zone_name",
        "service_zone",
        touches(rules.airport_zone_ids, "zone_id").alias("is_airport_zone"),
    )


def dim_date(dated: DataFrame) -> DataFrame:
    """Calendar attributes of the dates present in any frame that has pickup_date."""
    day = F.col("date")
    weekday = F.weekday(day) + 1
    return (
        dated.select(F.col("pickup_date").alias("date"))
        .distinct()
        .select(
            day,
            (F.year(day) * 10_000 + F.month(day) * 100 + F.day(day)).alias("date_key"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.day(day).alias("day"),
            F.date_format(day, "EEEE").alias("day_name"),
            weekday.alias("iso_day_of_week"),
            (weekday >= 6).alias("is_weekend"),
        )
    )


def dim_hour(spark: SparkSession) -> DataFrame:
    hour = F.col("hour")
    part = F.lit(OTHER_DAY_PART)
    for name, (first, last) in DAY_PARTS.items():
        part = F.when(hour.between(first, last), name).otherwise(part)
    label = F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))
    return spark.range(24).select(F.col("id").cast("int").alias("hour")).select(
        hour, label.alias("hour_label"), part.alias("day_part")
    )


def _labels(spark: SparkSession, rows: list[tuple[int, str]], code: str, label: str) -> DataFrame:
    """A literal relation whose small size the optimizer knows."""
    members = [F.struct(F.lit(number).alias(code), F.lit(text).alias(label)) for number, text in rows]
    return spark.range(1).select(F.inline(F.array(*members)))


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _labels(spark, PAYMENT_TYPES, "payment_type", "payment_type_name")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return _labels(spark, RATE_CODES, "rate_code_id", "rate_code_name")


def mart_anomalous_trips(fact: DataFrame, rules: Rules) -> DataFrame:
    """Warned trips, trips without distance or time, and fast trips; reasons may be empty."""
    unusual = (
        (F.col("quality_status") == "warning")
        | (F.col("trip_distance") == 0)
        | (F.col("duration_minutes") == 0)
        | (F.col("average_speed_mph") > rules.anomaly_speed_mph)
    )
    return fact.where(unusual)
