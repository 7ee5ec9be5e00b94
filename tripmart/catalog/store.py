"""The warehouse built from one folder of driver tables, once per session."""

from __future__ import annotations

from collections.abc import Mapping
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans.pipeline import replace_months
from tripmart.plans.warehouse import Warehouse
from tripmart.session import shared_folder, written
from tripmart.sources.driver_tables import DRIVER_INGESTED_AT, DRIVER_RULES, driver_trips, driver_zone_lookup
from tripmart.sources.schema import conform


def new_folder(spark: SparkSession, name: str, sf_dir: str) -> str:
    """A folder of this application in the shared place, per query purpose and input folder."""
    scale = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    return f"{shared_folder(spark)}/tripmart/{spark.sparkContext.applicationId}/{name}-{scale}"


def stored_trips(spark: SparkSession, sf_dir: str, by_order_month: bool = False) -> DataFrame:
    """Conformed driver trips as raw files would hold them: lines and orders are joined once, however often a run reads its trips."""
    return written(conform(driver_trips(spark, sf_dir, by_order_month)), "raw-trips", compression="zstd")


_BUILT: dict[tuple, Warehouse] = {}
_BUILDING = Lock()
INPUTS = ("lineitem", "orders", "nation", "region")


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and last change of the input tables, so that changed inputs are not answered from an old build."""
    state = []
    for name in INPUTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        state += [files.getContentSummary(path).getLength(), files.getFileStatus(path).getModificationTime()]
    return tuple(state)


def driver_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Staging, rollups, marts and summary of the driver tables; later calls reuse them while the inputs are the same."""
    with _BUILDING:
        return _warehouse(spark, sf_dir)


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir, *input_state(spark, sf_dir))
    if key not in _BUILT:
        warehouse = Warehouse(spark, new_folder(spark, "warehouse", sf_dir), DRIVER_RULES)
        trips = stored_trips(spark, sf_dir)
        replace_months(trips, driver_zone_lookup(spark, sf_dir), warehouse, DRIVER_INGESTED_AT)
        _BUILT[key] = warehouse
    return _BUILT[key]


_HISTORY: dict[tuple, tuple[Warehouse, int]] = {}


def driver_history(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, int]:
    """All order months, the newest of which was loaded again with late rows, and the snapshot before those.

    A third of the newest month's rows come late.
    """
    with _BUILDING:
        key = (spark.sparkContext.applicationId, sf_dir, *input_state(spark, sf_dir))
        if key not in _HISTORY:
            warehouse = Warehouse(spark, new_folder(spark, "history", sf_dir), DRIVER_RULES)
            trips = stored_trips(spark, sf_dir, by_order_month=True)
            newest = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.year(F.max("o_orderdate")).alias("year"), F.month(F.max("o_orderdate")).alias("month")).first()
            in_newest = (F.col("source_year") == newest.year) & (F.col("source_month") == newest.month)
            zones = driver_zone_lookup(spark, sf_dir)
            replace_months(trips.where(~(in_newest & (F.col("source_row_number") % 3 == 0))), zones, warehouse, DRIVER_INGESTED_AT)
            before = warehouse.snapshot.number
            replace_months(trips.where(in_newest), zones, warehouse, DRIVER_INGESTED_AT)
            _HISTORY[key] = (warehouse, before)
        return _HISTORY[key]


def driver_relations(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return driver_warehouse(spark, sf_dir).relations()
