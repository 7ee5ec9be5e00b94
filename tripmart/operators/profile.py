"""Profile of a raw trip source: nulls, ranges and means in one pass."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.files import parquet_footers
from tripmart.sources.trips import schema_groups

# Raw columns that are counted, ranged and averaged.
NULL_COUNTED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "passenger_count",
    "PULocationID",
    "DOLocationID",
)
RANGED = {"pickup": "tpep_pickup_datetime", "dropoff": "tpep_dropoff_datetime"}
AVERAGED = ("trip_distance", "fare_amount", "total_amount")


def profile_columns(raw: DataFrame) -> DataFrame:
    """One row of statistics; columns the source lacks are left out."""
    present = set(raw.columns)
    stats = [F.count("*").alias("row_count")]
    stats += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in NULL_COUNTED if c in present]
    for label, column in RANGED.items():
        if column in present:
            stats += [F.min(column).alias(f"{label}_min"), F.max(column).alias(f"{label}_max")]
    for column in AVERAGED:
        if column in present:
            stats += [
                F.min(column).alias(f"{column}_min"),
                F.max(column).alias(f"{column}_max"),
                F.avg(column).alias(f"{column}_avg"),
            ]
    return raw.agg(*stats)


def profile_files(spark: SparkSession, paths: Sequence[str]) -> dict[str, Any]:
    """Footer facts and column statistics of one raw source, as one nested document."""
    footers = parquet_footers(spark, paths)
    rows, groups = footers.agg(F.sum("row_count"), F.sum("row_groups")).first()
    groups_of_files = [spark.read.parquet(*group) for group in schema_groups(spark, paths)]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups_of_files)
    size = spark.read.format("binaryFile").load(list(paths)).agg(F.sum("length")).first()[0]
    stats = profile_columns(raw).first().asDict()

    def plain(value: Any) -> Any:
        return value.isoformat() if hasattr(value, "isoformat") else value

    present = set(raw.columns)
    return {
        "source_paths": list(paths),
        "file_size": size,
        "row_count": rows,
        "row_groups": groups,
        "column_names": raw.columns,
        "schema": {field.name: field.dataType.simpleString() for field in raw.schema.fields},
        "null_counts": {c: stats[f"{c}_nulls"] for c in NULL_COUNTED if c in present},
        "datetime_ranges": {
            label: {edge: plain(stats[f"{label}_{edge}"]) for edge in ("min", "max")}
            for label, column in RANGED.items()
            if column in present
        },
        "numeric_stats": {
            c: {stat: stats[f"{c}_{stat}"] for stat in ("min", "max", "avg")} for c in AVERAGED if c in present
        },
    }


def write_profile(spark: SparkSession, profile: dict[str, Any], folder: str) -> None:
    """Store one profile as a JSON document; a rerun replaces it."""
    document = json.dumps(profile, sort_keys=True)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(folder)
