"""Scans of raw trip files, and bounded samples of them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import Month
from tripmart.errors import InvalidRequest
from tripmart.operators.ordinals import file_counts, file_offsets, with_global_ordinal
from tripmart.sources.files import parquet_footers
from tripmart.sources.schema import conform


def with_file_lineage(raw: DataFrame, month: Month) -> DataFrame:
    """Add the row's ordinal in its file, the file and the month that was asked for."""
    return raw.select(
        *[F.col(f"`{name}`") for name in raw.columns],
        (F.col("_metadata.row_index") + 1).alias("source_row_number"),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(month.service).alias("service"),
        F.lit(month.year).alias("source_year"),
        F.lit(month.month).alias("source_month"),
    )


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[list[str]]:
    """Files put together by equal schema; one file, the usual case, needs no look at footers."""
    if len(files) < 2:
        return [list(files)]
    by_schema: dict[str, list[str]] = defaultdict(list)
    for row in parquet_footers(spark, files).select("path", "schema").toLocalIterator():
        by_schema[row.schema].append(row.path)
    return [sorted(by_schema[key]) for key in sorted(by_schema)]


def read_month(spark: SparkSession, path: str, month: Month) -> DataFrame:
    """Typed trips of one month.

    Source files of a month may differ in column types, so files are read per distinct schema
    and united after conforming. Rows are numbered through all files in path order.
    """
    files = month_files(spark, path)
    parts = [
        conform(with_file_lineage(spark.read.parquet(*group), month)) for group in schema_groups(spark, files)
    ]
    trips = reduce(DataFrame.unionByName, parts)
    if len(files) < 2:
        return trips
    numbered = with_global_ordinal(trips, file_offsets(file_counts(trips), len(files)))
    return numbered.select(*trips.columns)


def month_files(spark: SparkSession, path: str) -> list[str]:
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(path).inputFiles()


def first_rows(frame: DataFrame, count: int, *order: str) -> DataFrame:
    """The first rows in a stated order; a top-k, never a full sort."""
    if count <= 0:
        raise InvalidRequest("a sample needs at least one row")
    return frame.orderBy(*order).limit(count)


def write_sample(spark: SparkSession, source: str, destination: str, count: int) -> int:
    """Write the first rows of one file, all columns, and return how many there were."""
    if count <= 0:
        raise InvalidRequest("a sample needs at least one row")
    rows = spark.read.parquet(source).where(F.col("_metadata.row_index") < count)
    rows.coalesce(1).write.mode("overwrite").parquet(destination)
    return spark.read.parquet(destination).count()
