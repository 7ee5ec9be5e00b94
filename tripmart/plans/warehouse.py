"""The stored tables: layout, reading as of a snapshot, and replacement of whole months in one change."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cached_property, partial, reduce
from threading import Lock

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import MONTH_COLUMNS, Month, Rules
from tripmart.errors import MissingRelation
from tripmart.operators.ranking import in_months
from tripmart.plans import models, rollups
from tripmart.plans.snapshots import COMMIT, WHOLE, Snapshot, SnapshotLog
from tripmart.sources.schema import CLASSIFIED_SCHEMA

VALIDATED, REJECTED = "validated", "rejected"
OUTCOMES = (VALIDATED, REJECTED)

MONTH_FIELDS = [
    T.StructField("service", T.StringType()),
    T.StructField("source_year", T.IntegerType()),
    T.StructField("source_month", T.IntegerType()),
]
TRIPS_SCHEMA = T.StructType(
    [f for f in CLASSIFIED_SCHEMA.fields if f.name not in MONTH_COLUMNS]
    + [T.StructField("outcome", T.StringType()), *MONTH_FIELDS]
)
ZONES_SCHEMA = "location_id int, borough string, zone_name string, service_zone string"

ROLLUPS = {"time_rollup": rollups.time_rollup, "route_rollup": rollups.route_rollup}
ANOMALIES = "mart_anomalous_trips"
ANOMALY_BODY = [name for name in models.FACT_COLUMNS if name not in MONTH_COLUMNS]

# The route rollup added up over dates: one row for each source month and route.
ROUTE_MONTHS = "route_months"

# Marts keyed by date, stored by pickup month, and marts over all dates.
PERIOD = "period"
DATE_MARTS = {
    "mart_daily_trip_metrics": rollups.mart_daily,
    "mart_hourly_demand": rollups.mart_hourly,
    "mart_revenue_metrics": rollups.mart_revenue,
}
ROUTE_MARTS = {"mart_zone_demand": rollups.mart_zone, "mart_route_metrics": rollups.mart_route}


def side_by_side(jobs: Sequence[Callable[[], None]]) -> None:
    """Submit a few independent Spark jobs together; the first failure is raised."""
    failures: list[Exception] = []

    def run(job: Callable[[], None]) -> None:
        try:
            job()
        except Exception as error:  # noqa: BLE001 - handed to the caller below
            failures.append(error)

    threads = [InheritableThread(target=run, args=(job,)) for job in jobs]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failures:
        raise failures[0]


def by_partition(columns: Sequence[str], values: Mapping[tuple, int], kind: str) -> Column:
    """A number per partition, looked up by its key columns; NULL for partitions not listed."""
    pairs = [F.lit(item) for key, number in values.items() for item in ("/".join(map(str, key)), number)]
    lookup = F.create_map(*pairs).cast(f"map<string, {kind}>")
    return lookup[F.concat_ws("/", *[F.col(column).cast("string") for column in columns])]


class Warehouse:
    """Tables under one root folder, as one snapshot shows them.

    `trips` holds every classified row, split by outcome and month: its `validated` part is the
    staging table, its `rejected` part the rejected sink. Rollups and the anomaly mart are
    stored per source month, marts by date per pickup month, so replacing a month recomputes what it touches. Without a pinned snapshot
    every call reads the newest one; `relations` pins it for all relations it gives. Writes go through `change`.
    """

    def __init__(self, spark: SparkSession, root: str, rules: Rules, snapshot: Snapshot | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.rules = rules
        self.log = SnapshotLog(spark, self.root)
        self._pinned = snapshot
        self._schemas: dict[str, T.StructType] = {}

    @property
    def snapshot(self) -> Snapshot:
        return self.log.newest() if self._pinned is None else self._pinned

    def at(self, snapshot: Snapshot | int | None = None) -> Warehouse:
        """The warehouse as of a snapshot (the newest one if none is given), whatever is written later."""
        if isinstance(snapshot, int):
            snapshot = self.log.read(snapshot)
        return Warehouse(self.spark, self.root, self.rules, self.snapshot if snapshot is None else snapshot)

    def change(self) -> Change:
        return Change(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType | str, keys: Sequence[str] = ()) -> DataFrame:
        """Rows of a table in this snapshot. Folders of other commits are pruned by their names."""
        snapshot = self.snapshot
        if not snapshot.parts(name):
            raise MissingRelation(f"table {name} has not been written")
        fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        placed = T.StructType([*fields.fields, T.StructField(COMMIT, T.IntegerType())])
        rows = self.spark.read.schema(placed).parquet(self.path(name))
        return rows.where(snapshot.holds(name, [F.col(key) for key in keys])).drop(COMMIT)

    def month_folder(self, outcome: str, month: Month) -> str:
        """Where this snapshot keeps a month's rows of one outcome."""
        commit = self.snapshot.parts("trips")[f"{month.service}/{month.year}/{month.month}"]
        return self.path(f"trips/{COMMIT}={commit}/outcome={outcome}/service={month.service}/source_year={month.year}/source_month={month.month}")

    def outcome(self, outcome: str) -> DataFrame:
        """Classified rows of one outcome, in contract column order."""
        stored = self._read("trips", TRIPS_SCHEMA, MONTH_COLUMNS).where(F.col("outcome") == outcome)
        return stored.select(*CLASSIFIED_SCHEMA.names)

    def classified(self) -> DataFrame:
        return self._read("trips", TRIPS_SCHEMA, MONTH_COLUMNS).select(*CLASSIFIED_SCHEMA.names)

    def staging(self) -> DataFrame:
        return self.outcome(VALIDATED)

    def zones(self) -> DataFrame:
        return self._read("zones", ZONES_SCHEMA)

    def relations(self) -> StoredRelations:
        return StoredRelations(self.at())

    def stored(self, name: str) -> DataFrame:
        """A derived table, read with the schema its definition gives (no file is opened for it)."""
        schema = self._derived_schema(name)
        if name in ROUTE_MARTS:
            return self._read(name, schema)
        if name in DATE_MARTS:
            return self._read(name, T.StructType([*schema.fields, T.StructField(PERIOD, T.IntegerType())]), [PERIOD]).drop(PERIOD)
        table = self._read(name, schema, MONTH_COLUMNS)
        return table.select(*models.FACT_COLUMNS) if name == ANOMALIES else table

    @cached_property
    def _empty_trips(self) -> DataFrame:
        return models.with_pickup_clock(self.spark.createDataFrame([], CLASSIFIED_SCHEMA))

    def _derived_schema(self, name: str) -> T.StructType:
        if name not in self._schemas:
            if name in ROLLUPS:
                derived = ROLLUPS[name](self._empty_trips, *MONTH_COLUMNS)
            elif name == ROUTE_MONTHS:
                derived = rollups.route_months(rollups.route_rollup(self._empty_trips, *MONTH_COLUMNS), *MONTH_COLUMNS)
            elif name == ANOMALIES:
                derived = self._empty_trips.select(*ANOMALY_BODY, *MONTH_COLUMNS)
            elif name in DATE_MARTS:
                derived = DATE_MARTS[name](rollups.time_rollup(self._empty_trips))
            else:
                derived = ROUTE_MARTS[name](rollups.route_rollup(self._empty_trips))
            self._schemas[name] = derived.schema
        return self._schemas[name]


def period_of(date: str = "pickup_date") -> Column:
    """The calendar month of a date as one number; 0 without a date."""
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))


class Change(Warehouse):
    """All writes of one run. Reads through it see them; everybody else sees them together once `commit` is done, or never."""

    def __init__(self, warehouse: Warehouse) -> None:
        super().__init__(warehouse.spark, warehouse.root, warehouse.rules, warehouse.log.newest())
        self.base = warehouse.at(self._pinned)
        self.number = self.log.claim_commit()
        self._lock = Lock()

    def commit(self) -> Snapshot:
        """Publish the run's writes. Raises CommitConflict if another run was published since this one began."""
        done = self.log.publish(self.snapshot, self.base.snapshot)
        self.log.clean()
        return done

    def _written(self, name: str, rows: DataFrame, parts: Sequence[str], *layout: str) -> None:
        writer = rows.write.option("compression", "zstd")
        (writer.partitionBy(*layout) if layout else writer).parquet(f"{self.path(name)}/{COMMIT}={self.number}")
        with self._lock:
            self._pinned = self.snapshot.with_parts(name, parts, self.number)

    def replace_table(self, name: str, rows: DataFrame) -> None:
        self._written(name, rows, [WHOLE])

    def replace_zones(self, zones: DataFrame) -> None:
        self.replace_table("zones", zones)

    def replace_partitions(self, name: str, rows: DataFrame, keys: Sequence[str], parts: Sequence[tuple], *layout: str) -> None:
        """Replace exactly the given parts of a table by the given rows; a part without rows is then empty.

        Folders are laid out by `layout` and the keys. Rows of other parts must not be given.
        """
        self._written(name, rows, ["/".join(map(str, values)) for values in parts], *layout, *keys)

    def derive_months(self, months: Sequence[Month]) -> None:
        """Recompute rollups and anomalies of the given months from their staged rows."""
        keys = [(m.service, m.year, m.month) for m in months]
        staged = models.with_pickup_clock(models.stg_trips(self.staging().where(in_months(months))))
        # Sorted by date inside each month, so that date filters skip row groups.
        tables = {name: rollup(staged, *MONTH_COLUMNS).sortWithinPartitions(*MONTH_COLUMNS, "pickup_date") for name, rollup in ROLLUPS.items()}
        unusual = models.mart_anomalous_trips(staged, self.rules)
        tables[ANOMALIES] = unusual.select(*ANOMALY_BODY, *MONTH_COLUMNS).sortWithinPartitions(*MONTH_COLUMNS, "pickup_date")
        side_by_side([partial(self.replace_partitions, name, rows, MONTH_COLUMNS, keys) for name, rows in tables.items()])

    def refresh_marts(self, months: Sequence[Month]) -> None:
        """Bring the marts up to date after the given months were derived.

        Marts by date are recomputed for the pickup months that the months' trips lie in, before or after the change; other pickup months keep
        their files. Marts by zone and route re-add one row for each source month and route.
        """
        keys = [(m.service, m.year, m.month) for m in months]
        by_date = self._refresh_date_marts
        by_month = rollups.route_months(self.stored("route_rollup").where(in_months(months)), *MONTH_COLUMNS)

        def by_route() -> None:
            self.replace_partitions(ROUTE_MONTHS, by_month, MONTH_COLUMNS, keys)
            routes = self.stored(ROUTE_MONTHS)
            side_by_side([partial(self.replace_table, name, build(routes)) for name, build in ROUTE_MARTS.items()])

        side_by_side([partial(by_date, months), by_route])

    def _refresh_date_marts(self, months: Sequence[Month]) -> None:
        periods = self.touched_periods(months)
        ends = [F.make_date(F.lit(p // 100), F.lit(p % 100), F.lit(1)) for p in (periods[:1] + periods[-1:]) if p]
        rows = self.stored("time_rollup").where(period_of().isin(periods))
        if len(ends) == 2:  # lets the scan skip row groups
            rows = rows.where((F.col("pickup_date") >= ends[0]) & (F.col("pickup_date") <= F.last_day(ends[1])))
        # One file for each pickup month: a mart has a few rows for each of its dates, so this is never much.
        tables = {name: build(rows).withColumn(PERIOD, period_of()).repartition(PERIOD).sortWithinPartitions(PERIOD, "pickup_date") for name, build in DATE_MARTS.items()}
        side_by_side([partial(self.replace_partitions, name, table, [PERIOD], [(p,) for p in periods]) for name, table in tables.items()])

    def touched_periods(self, months: Sequence[Month]) -> list[int]:
        """Pickup months in which the given source months have or had trips; a number for each, so the list is short."""
        states = [self, self.base] if self.base.snapshot.parts("time_rollup") else [self]
        found = [state.stored("time_rollup").where(in_months(months)).select(period_of().alias(PERIOD)) for state in states]
        return sorted(row[PERIOD] for row in reduce(DataFrame.union, found).distinct().collect())


class StoredRelations(Mapping[str, DataFrame]):
    """Every relation of a warehouse by name; a relation is only opened when it is asked for."""

    def __init__(self, warehouse: Warehouse) -> None:
        spark, rules = warehouse.spark, warehouse.rules

        def staged() -> DataFrame:
            return models.stg_trips(warehouse.staging())

        def zones() -> DataFrame:
            return models.stg_zones(warehouse.zones())

        self._builders: dict[str, Callable[[], DataFrame]] = {
            "yellow_trips": warehouse.staging,
            "taxi_zones": warehouse.zones,
            "stg_trips": staged,
            "stg_zones": zones,
            "fct_trips": lambda: models.fct_trips(staged()),
            "dim_zone": lambda: models.dim_zone(zones(), rules),
            "dim_date": lambda: models.dim_date(warehouse.stored("time_rollup")),
            "dim_hour": lambda: models.dim_hour(spark),
            "dim_payment_type": lambda: models.dim_payment_type(spark),
            "dim_rate_code": lambda: models.dim_rate_code(spark),
        }
        for name in (*ROLLUPS, ROUTE_MONTHS, *DATE_MARTS, *ROUTE_MARTS, ANOMALIES):
            self._builders[name] = partial(warehouse.stored, name)

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
