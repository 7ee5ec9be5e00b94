"""Tables that cut lineage, in the folder the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir where it is set; else, as in tests, the warehouse, which all executors share as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


# Folders written since `settled` began, innermost call only.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back; lost executors then recompute nothing before it."""
    spark = frame.sparkSession
    folder = new_folder(spark, name)
    written = _written.get()
    if written is not None:
        written.append(folder)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `build` returns, stored; the tables written on the way are removed once it is complete."""
    written: list[str] = []
    token = _written.set(written)
    try:
        frame = build()
    finally:
        _written.reset(token)
    result = stored(frame, name)
    for folder in written:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return result


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(column: str, modulus: int, remainder: int):
    """crc32 of the id's decimal text, modulo; a row without id is never held out and never learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def bounded_rows(frame: DataFrame, key: str, most: int) -> DataFrame:
    """The `most` rows with the smallest hashes of the key (all, if there are fewer), whatever their order and partitions.

    Rows are counted first and only hashes below a bound that leaves about a fifth more than wanted are sorted, so
    tasks together hand on a bounded number of rows however many tasks there are.
    """
    total = frame.count()
    order = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 53))
    if total > most:
        frame = frame.where(order < int((1 << 53) * min(1.0, (1.2 * most + 100) / total)))
    return frame.orderBy(order, F.col(key)).limit(most)
