"""Classification of trips as valid, warning or rejected, with named reasons."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import Rules
from tripmart.functions.trip import (
    elapsed_seconds,
    miles_per_hour,
    minutes,
    per_mile,
    touches,
    trip_id,
)
from tripmart.operators.ranking import DayPlaces, rank_copies
from tripmart.sources.schema import CLASSIFIED_SCHEMA

REASON_SEPARATOR = "|"
STATUSES = ("valid", "warning", "rejected")


def rejection_rules(rules: Rules) -> dict[str, Column]:
    """Rule name to predicate, in the order reasons are listed. Any hit rejects the trip."""
    c = F.col
    pickup, dropoff = c("pickup_datetime"), c("dropoff_datetime")
    span = c("duration_minutes")
    return {
        "missing_pickup_datetime": pickup.isNull(),
        "missing_dropoff_datetime": dropoff.isNull(),
        "pickup_after_dropoff": pickup > dropoff,
        "duration_out_of_range": (span < 0) | (span > rules.max_duration_minutes),
        "missing_trip_distance": c("trip_distance").isNull(),
        "negative_trip_distance": c("trip_distance") < 0,
        "missing_fare_amount": c("fare_amount").isNull(),
        "negative_fare_amount": c("fare_amount") < 0,
        "missing_total_amount": c("total_amount").isNull(),
        "negative_total_amount": c("total_amount") < 0,
        "negative_passenger_count": c("passenger_count") < 0,
        "invalid_pickup_zone": c("_pickup_known").isNull(),
        "invalid_dropoff_zone": c("_dropoff_known").isNull(),
        "unreasonable_average_speed": c("average_speed_mph") > rules.max_speed_mph,
    }


def warning_rules() -> dict[str, Column]:
    """Rule name to predicate for trips that stay loadable but are flagged."""
    return {
        "zero_duration_positive_distance": (F.col("duration_minutes") == 0) & (F.col("trip_distance") > 0),
        "duplicate_record": F.col("duplicate_rank") > 1,
    }


def with_measures(trips: DataFrame) -> DataFrame:
    """Duration, average speed and revenue per mile."""
    timed = trips.withColumn("_seconds", elapsed_seconds("pickup_datetime", "dropoff_datetime"))
    distance = F.col("trip_distance")
    return timed.withColumns(
        {
            "duration_minutes": minutes(F.col("_seconds")),
            "average_speed_mph": miles_per_hour(distance, F.col("_seconds")),
            "revenue_per_mile": per_mile(F.col("total_amount"), distance),
        }
    ).drop("_seconds")


def with_zone_flags(trips: DataFrame, zone_ids: DataFrame) -> DataFrame:
    """Mark endpoints found among the zone ids, one row per trip as before.

    Spark compares the id set's size with its broadcast threshold and otherwise shuffles.
    """
    known = zone_ids.select("zone_id").distinct()
    pickup = known.select(F.col("zone_id").alias("pickup_zone_id"), F.lit(True).alias("_pickup_known"))
    dropoff = known.select(F.col("zone_id").alias("dropoff_zone_id"), F.lit(True).alias("_dropoff_known"))
    return trips.join(pickup, "pickup_zone_id", "left").join(dropoff, "dropoff_zone_id", "left")


def _fired(named: dict[str, Column]) -> Column:
    return F.concat_ws(REASON_SEPARATOR, *[F.when(test, F.lit(name)) for name, test in named.items()])


def utc_second(moment: datetime) -> datetime:
    """A moment as UTC wall clock to the second; a time without zone is taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.replace(microsecond=0, tzinfo=None)


def classify(
    trips: DataFrame,
    zone_ids: DataFrame,
    rules: Rules,
    ingested_at: datetime,
    hot: Sequence[int] = (),
    buckets: Column | None = None,
    days: DayPlaces | None = None,
) -> DataFrame:
    """Every input row once, with measures, identity, status and all reasons that apply.

    Only typed columns, lineage and a short number or 64-bit record key are shuffled (once, to number copies);
    hash, measures, zone marks and rules are computed after it.
    """
    ranked = rank_copies(trips, hot, buckets, days=days)
    flagged = with_zone_flags(with_measures(ranked), zone_ids)
    judged = flagged.withColumns(
        {"_rejections": _fired(rejection_rules(rules)), "_warnings": _fired(warning_rules())}
    )
    none = F.lit("")
    status = (
        F.when(F.col("_rejections") != none, "rejected")
        .when(F.col("_warnings") != none, "warning")
        .otherwise("valid")
    )
    reasons = F.concat_ws(
        REASON_SEPARATOR, F.nullif(F.col("_rejections"), none), F.nullif(F.col("_warnings"), none)
    )
    return judged.withColumns(
        {
            "trip_id": trip_id(F.col("stable_record_hash"), F.col("duplicate_rank")),
            "is_airport_trip": touches(rules.airport_zone_ids, "pickup_zone_id", "dropoff_zone_id"),
            "quality_status": status,
            "quality_reasons": reasons,
            "ingested_at": F.lit(utc_second(ingested_at)).cast("timestamp_ntz"),
        }
    ).select(*CLASSIFIED_SCHEMA.names)


def loadable(classified: DataFrame) -> DataFrame:
    return classified.where("quality_status <> 'rejected'")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where("quality_status = 'rejected'")
