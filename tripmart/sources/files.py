"""File-level metadata read on executors: Parquet footers and a checksummed inventory."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTER_SCHEMA = "path string, row_count bigint, row_groups int, column_names array<string>, schema string"
CHECKSUM_SCHEMA = "path string, file_size bigint, modified_at timestamp, sha256 string, row_count bigint"
CHUNK_BYTES = 8 << 20

# The readers below travel to executors with the job, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _open(path: str):
    uri = path if "://" in path else path.replace("file:", "", 1)
    filesystem, inner = pafs.FileSystem.from_uri(uri)
    return filesystem, inner


def _footers(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path in batch["path"]:
            filesystem, inner = _open(path)
            with filesystem.open_input_file(inner) as handle:
                parquet = pq.ParquetFile(handle)
                fields = parquet.schema_arrow
                rows.append(
                    (
                        path,
                        parquet.metadata.num_rows,
                        parquet.metadata.num_row_groups,
                        list(fields.names),
                        ", ".join(f"{field.name}: {field.type}" for field in fields),
                    )
                )
        yield pd.DataFrame(rows, columns=["path", "row_count", "row_groups", "column_names", "schema"])


def table_files(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """Files and rows of each Parquet table, counted by Spark from file metadata alone; no list of files is made."""
    counted = [
        spark.read.parquet(f"{root}/{name}.parquet")
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("n"))
        .agg(F.count("*").alias("file_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "file_count", "row_count")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counted)


def parquet_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Row count, row groups and schema of each file; only footers are read."""
    listing = spark.createDataFrame([(path,) for path in paths], "path string")
    return listing.repartition("path").mapInPandas(_footers, FOOTER_SCHEMA)


def _checksums(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests, counts = [], []
        for path in batch["path"]:
            filesystem, inner = _open(path)
            digest = hashlib.sha256()
            with filesystem.open_input_stream(inner) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
            with filesystem.open_input_file(inner) as handle:
                is_parquet = inner.endswith(".parquet")
                counts.append(pq.ParquetFile(handle).metadata.num_rows if is_parquet else None)
        yield batch.assign(sha256=digests, row_count=pd.array(counts, dtype="Int64"))[
            ["path", "file_size", "modified_at", "sha256", "row_count"]
        ]


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Size, checksum, row count and time of every file under a folder.

    Spark lists the files and packs them into tasks by size; a task then streams each file in
    small chunks, so file size is not limited by memory.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"))
    )
    return listing.mapInPandas(_checksums, CHECKSUM_SCHEMA).withColumn("status", F.lit("present"))


def append_inventory(inventory: DataFrame, manifest: str) -> None:
    """Add one inventory run to the manifest table; earlier entries stay."""
    inventory.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(manifest)
