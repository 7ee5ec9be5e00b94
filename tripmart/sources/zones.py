"""Zone lookup: the CSV scan, the loaded zone table and the id set for validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.errors import ZoneLookupError


def read_zone_file(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the lookup as text, by header name; a leading byte-order mark is harmless.

    Quoting is standard CSV: a doubled quote is a quote, and a quoted field may span lines.
    """
    lookup = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    if "LocationID" not in lookup.columns:
        raise ZoneLookupError(f"zone lookup has no LocationID column: {path}")
    return lookup


def zone_table(lookup: DataFrame) -> DataFrame:
    """Zones for loading: rows whose id is not a number are left out."""
    return lookup.select(
        F.rint(F.col("LocationID").try_cast("double")).try_cast("int").alias("location_id"),
        F.col("Borough").cast("string").alias("borough"),
        F.col("Zone").cast("string").alias("zone_name"),
        F.col("service_zone").cast("string").alias("service_zone"),
    ).where("location_id IS NOT NULL")


def zone_ids(lookup: DataFrame) -> DataFrame:
    """Distinct ids for validation; blanks are skipped, anything else must be a whole number."""
    text = F.trim(F.col("LocationID").cast("string"))
    given = lookup.select(text.alias("text")).where("text <> ''")
    ids = given.select("text", F.col("text").try_cast("int").alias("zone_id"))
    bad, good = ids.agg(F.count_if(F.col("zone_id").isNull()), F.count("zone_id")).first()
    if bad:
        raise ZoneLookupError(f"zone lookup holds {bad} ids that are not whole numbers")
    if not good:
        raise ZoneLookupError("zone lookup holds no zone ids")
    return ids.select("zone_id").distinct()
