"""Structured Streaming job that reprocesses exactly the months that received new files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripmart.config import MONTH_COLUMNS, Month
from tripmart.plans.pipeline import replace_months
from tripmart.plans.warehouse import Warehouse
from tripmart.sources.trips import read_month

ARRIVAL_SCHEMA = "service string, source_year int, source_month int"


def ingest_arrivals(
    spark: SparkSession,
    raw_root: str,
    checkpoint: str,
    zones: Callable[[], DataFrame],
    warehouse: Warehouse,
    now: Callable[[], datetime],
) -> StreamingQuery:
    """Process all files that arrived under {raw_root}/service=/source_year=/source_month=.

    A batch only tells which months changed. Those months are read again in full, because copy
    numbers depend on every row of a month. Replacing a month is idempotent, so a batch that is
    repeated after a failure does no harm.
    """
    arrivals = spark.readStream.schema(ARRIVAL_SCHEMA).parquet(raw_root)

    def reprocess(batch: DataFrame, _: int) -> None:
        touched = sorted(Month(*row) for row in batch.select(*MONTH_COLUMNS).distinct().collect())
        if touched:
            # One run and one stamp for the batch, however many months it touched.
            trips = [read_month(spark, f"{raw_root}/{month.directory}", month) for month in touched]
            replace_months(reduce(DataFrame.unionByName, trips), zones(), warehouse, now(), touched)

    return (
        arrivals.writeStream.foreachBatch(reprocess)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
