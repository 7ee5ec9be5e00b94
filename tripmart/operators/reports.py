"""Further reports over classified trips: anomaly flags, rejections by rule, out-of-month trips, schema drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import MONTH_COLUMNS
from tripmart.operators.classify import REASON_SEPARATOR
from tripmart.sources.schema import LINEAGE_COLUMNS, TRIP_COLUMNS, conform, source_field


@dataclass(frozen=True)
class AnomalyLimits:
    """From which amounts on a trip is flagged."""

    zero_distance_fare: float = 50.0
    fare_per_mile: float = 25.0
    airport_like_fare: float = 90.0


def anomaly_flag_tests(limits: AnomalyLimits) -> dict[str, Column]:
    """Flag name to test, in the order flags are listed."""
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    return {
        "zero_distance_high_fare": (distance == 0) & (fare >= limits.zero_distance_fare),
        "high_fare_per_mile": (distance > 0) & (fare / distance > limits.fare_per_mile),
        "airport_like_fare": (fare >= limits.airport_like_fare) & ~F.coalesce("is_airport_trip", F.lit(False)),
        "missing_location": F.col("pickup_zone_id").isNull() | F.col("dropoff_zone_id").isNull(),
    }


def anomaly_flags(classified: DataFrame, limits: AnomalyLimits = AnomalyLimits()) -> DataFrame:
    """Classified trips that carry a flag, whatever their status, with all flags that apply."""
    fired = [F.when(test, F.lit(name)) for name, test in anomaly_flag_tests(limits).items()]
    flags = F.concat_ws(REASON_SEPARATOR, *fired).alias("anomaly_flags")
    return classified.select("trip_id", "source_row_number", "quality_status", flags).where("anomaly_flags <> ''")


def rejected_summary(classified: DataFrame) -> DataFrame:
    """Rejected trips per rule, pickup zone and file; a trip counts under each of its rules.

    Trips are counted per reason text before rules are told apart, so few rows leave the scan.
    """
    rejected = classified.where("quality_status = 'rejected'")
    counted = rejected.groupBy("quality_reasons", "pickup_zone_id", "source_file").agg(F.count("*").alias("n"))
    named = counted.select(F.explode(F.split("quality_reasons", "[|]")).alias("rule"), "pickup_zone_id", "source_file", "n")
    return named.groupBy("rule", "pickup_zone_id", "source_file").agg(F.sum("n").alias("rejected_rows"))


def out_of_month(trips: DataFrame) -> DataFrame:
    """Typed trips per requested month, and how many begin or end outside it; a missing time is in no month."""

    def outside(column: str) -> Column:
        same = (F.year(column) == F.col("source_year")) & (F.month(column) == F.col("source_month"))
        return F.count_if(~same)

    return trips.groupBy(*MONTH_COLUMNS).agg(
        F.count("*").alias("trip_count"),
        outside("pickup_datetime").alias("pickups_outside"),
        outside("dropoff_datetime").alias("dropoffs_outside"),
    )


def schema_drift(raw: DataFrame) -> DataFrame:
    """Per file and contract column: the type it comes in, values it holds, and values lost in conforming.

    One aggregate over one scan; an absent column has type `absent` and no values.
    """
    kept = [name for name in LINEAGE_COLUMNS if name in raw.columns]
    fields = {column.name: source_field(raw, column) for column in TRIP_COLUMNS}
    given = [F.col(f"`{field.name}`").alias(f"_raw_{name}") for name, field in fields.items() if field is not None]
    both = conform(raw.select("*", *given), keep=[f"_raw_{name}" for name, field in fields.items() if field is not None])
    counts, rows = [], []
    for column in TRIP_COLUMNS:
        field = fields[column.name]
        held = F.col(f"_raw_{column.name}").isNotNull() if field is not None else F.lit(False)
        counts += [
            F.count_if(held).alias(f"{column.name}_held"),
            F.count_if(held & F.col(column.name).isNull()).alias(f"{column.name}_lost"),
        ]
        rows.append(
            F.struct(
                F.lit(column.name).alias("column_name"),
                F.lit("absent" if field is None else field.dataType.simpleString()).alias("source_type"),
                F.lit(column.kind).alias("target_type"),
                F.col(f"{column.name}_held").alias("source_values"),
                F.col(f"{column.name}_lost").alias("lost_values"),
            )
        )
    by = [name for name in kept if name == "source_file"]
    return both.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*rows)))
