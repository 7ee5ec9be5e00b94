"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on; everything else is left to the cluster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Do not record the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A mart has a folder for each pickup month; listing ten years of them is no job of its own.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "128",
    # Pages far down a list sort across the cluster instead of keeping limit+offset rows per task.
    "spark.sql.execution.topKSortFallbackThreshold": "1000000",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: spark.checkpoint.dir as the cluster names it, else the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def written(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """A frame written once to the shared folder and read back, so that every later use sees the same rows. `options` go to the writer."""
    spark = frame.sparkSession
    folder = f"{shared_folder(spark)}/tripmart/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)
