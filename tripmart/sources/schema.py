"""Column contract of trip data and conformance of drifting source schemas to it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import MONTH_COLUMNS
from tripmart.errors import SchemaError


@dataclass(frozen=True)
class TripColumn:
    name: str
    kind: str
    source_names: tuple[str, ...]
    required: bool = False


# The 19 typed trip columns, their types and the source names they may carry.
TRIP_COLUMNS = (
    TripColumn("vendor_id", "bigint", ("VendorID",)),
    TripColumn("pickup_datetime", "timestamp_ntz", ("tpep_pickup_datetime",), required=True),
    TripColumn("dropoff_datetime", "timestamp_ntz", ("tpep_dropoff_datetime",), required=True),
    TripColumn("passenger_count", "double", ("passenger_count",), required=True),
    TripColumn("trip_distance", "double", ("trip_distance",), required=True),
    TripColumn("rate_code_id", "int", ("RatecodeID", "rate_code_id")),
    TripColumn("store_and_fwd_flag", "string", ("store_and_fwd_flag",)),
    TripColumn("pickup_zone_id", "int", ("PULocationID",), required=True),
    TripColumn("dropoff_zone_id", "int", ("DOLocationID",), required=True),
    TripColumn("payment_type", "int", ("payment_type",)),
    TripColumn("fare_amount", "double", ("fare_amount",), required=True),
    TripColumn("extra", "double", ("extra",)),
    TripColumn("mta_tax", "double", ("mta_tax",)),
    TripColumn("tip_amount", "double", ("tip_amount",)),
    TripColumn("tolls_amount", "double", ("tolls_amount",)),
    TripColumn("improvement_surcharge", "double", ("improvement_surcharge",)),
    TripColumn("total_amount", "double", ("total_amount",), required=True),
    TripColumn("congestion_surcharge", "double", ("congestion_surcharge",)),
    TripColumn("airport_fee", "double", ("Airport_fee", "airport_fee")),
)

SPARK_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# Where a row came from. Together source_file and source_row_number name one physical row.
LINEAGE_COLUMNS = ("source_row_number", *MONTH_COLUMNS, "source_file")

MEASURE_FIELDS = (
    T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("average_speed_mph", T.DoubleType()),
    T.StructField("revenue_per_mile", T.DoubleType()),
)

CLASSIFIED_SCHEMA = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("stable_record_hash", T.StringType()),
        T.StructField("source_row_number", T.LongType()),
        *(T.StructField(c.name, SPARK_TYPES[c.kind]) for c in TRIP_COLUMNS),
        *MEASURE_FIELDS,
        T.StructField("is_airport_trip", T.BooleanType()),
        T.StructField("quality_status", T.StringType()),
        T.StructField("quality_reasons", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("source_year", T.IntegerType()),
        T.StructField("source_month", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)

def require_columns(raw: DataFrame) -> None:
    """Fail unless every mandatory source column is present under its exact name."""
    wanted = {c.source_names[0] for c in TRIP_COLUMNS if c.required}
    missing = sorted(wanted - set(raw.columns))
    if missing:
        raise SchemaError(f"trip source lacks required columns: {', '.join(missing)}")


def safe_cast(source: Column, source_type: T.DataType, kind: str) -> Column:
    """Cast that gives NULL instead of failing; fractions go to the nearest even integer."""
    if kind in ("int", "bigint") and not isinstance(source_type, T.IntegralType | T.BooleanType):
        return F.rint(source.try_cast("double")).try_cast(kind)
    return source.try_cast(kind)


def source_field(raw: DataFrame, column: TripColumn) -> T.StructField | None:
    """The source column that a typed column is taken from, found without regard to case."""
    present = {field.name.casefold(): field for field in raw.schema.fields}
    return next((present[n.casefold()] for n in column.source_names if n.casefold() in present), None)


def conform(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 19 typed trip columns plus whatever lineage columns the frame already carries, and those in `keep`."""
    require_columns(raw)
    typed = []
    for column in TRIP_COLUMNS:
        field = source_field(raw, column)
        value = (
            F.lit(None).cast(column.kind)
            if field is None
            else safe_cast(F.col(f"`{field.name}`"), field.dataType, column.kind)
        )
        typed.append(value.alias(column.name))
    lineage = [F.col(name) for name in LINEAGE_COLUMNS if name in raw.columns]
    return raw.select(*typed, *lineage, *keep)
