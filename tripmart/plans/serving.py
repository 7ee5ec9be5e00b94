"""The catalogue of served questions, as functions from relations to lazy frames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tripmart.config import SERVICES
from tripmart.errors import EmptyResult, InvalidRequest, MissingRelation, UnknownZone
from tripmart.operators.paging import DEFAULT_LIMIT, Page, PageRequest, at_zone, in_dates, page_of
from tripmart.plans.rollups import arrivals_by_zone, fact_figures, overview_totals, route_rollup, time_rollup, zone_totals

Relations = Mapping[str, DataFrame]

ROLLED_UP_MARTS = (
    "mart_daily_trip_metrics",
    "mart_hourly_demand",
    "mart_zone_demand",
    "mart_route_metrics",
    "mart_revenue_metrics",
)
MARTS = (*ROLLED_UP_MARTS, "mart_anomalous_trips")
KEY_RELATIONS = ("fct_trips", "dim_zone", *MARTS)

# Keys by which each list can be sorted.
DAILY_SORTS = ("pickup_date", "trip_count", "total_revenue", "average_duration_minutes")
HOURLY_SORTS = ("pickup_date", "pickup_hour", "trip_count", "total_revenue")
REVENUE_SORTS = ("pickup_date", "trip_count", "total_revenue", "payment_type")
ZONE_SORTS = ("zone_id", "zone_name", "pickup_trip_count", "total_revenue")
DROPOFF_SORTS = ("zone_id", "dropoff_trip_count", "total_revenue")
ROUTE_SORTS = ("trip_count", "total_revenue", "average_trip_distance", "average_duration_minutes")
ANOMALY_SORTS = ("pickup_datetime", "total_amount", "trip_distance", "average_speed_mph")


def _relation(relations: Relations, name: str) -> DataFrame:
    if name not in relations:
        raise MissingRelation(f"relation {name} is not available")
    return relations[name]


def _by_time(relations: Relations) -> DataFrame:
    """The stored time rollup, or one derived from the fact."""
    if "time_rollup" in relations:
        return relations["time_rollup"]
    return time_rollup(_relation(relations, "fct_trips"))


def _by_route(relations: Relations) -> DataFrame:
    if "route_rollup" in relations:
        return relations["route_rollup"]
    return route_rollup(_relation(relations, "fct_trips"))


def _same(names: tuple[str, ...]) -> dict[str, str]:
    return {name: name for name in names}


def zone_lookup(relations: Relations, zone_id: int) -> Row:
    """The dimension row of one zone; unknown zones are an error."""
    if zone_id < 1:
        raise InvalidRequest(f"zone ids start at 1, got {zone_id}")
    found = _relation(relations, "dim_zone").where(F.col("zone_id") == zone_id).take(1)
    if not found:
        raise UnknownZone(f"zone {zone_id} is not in the zone dimension")
    return found[0]


def overview(
    relations: Relations, start: date | None = None, end: date | None = None, zone_id: int | None = None
) -> DataFrame:
    """One row of key figures. Without a zone the time rollup answers, with one the route rollup."""
    if zone_id is None:
        return overview_totals(in_dates(_by_time(relations), start, end))
    zone_lookup(relations, zone_id)
    return overview_totals(at_zone(in_dates(_by_route(relations), start, end), zone_id))


def require_trips(figures: DataFrame) -> dict:
    """Fetch an overview row; no trips at all is an error."""
    row = figures.first().asDict()
    if row["total_trips"] == 0:
        raise EmptyResult("no trips for the given filters")
    return row


def daily_metrics(
    relations: Relations,
    start: date | None = None,
    end: date | None = None,
    page: PageRequest = PageRequest("pickup_date"),
) -> Page:
    rows = in_dates(_relation(relations, "mart_daily_trip_metrics"), start, end)
    return page_of(rows, page, _same(DAILY_SORTS), ("pickup_date",), rows, "daily metrics")


def hourly_demand(
    relations: Relations,
    start: date | None = None,
    end: date | None = None,
    page: PageRequest = PageRequest("pickup_date"),
) -> Page:
    rows = in_dates(_relation(relations, "mart_hourly_demand"), start, end)
    return page_of(rows, page, _same(HOURLY_SORTS), ("pickup_date", "pickup_hour"), rows, "hourly demand")


def revenue_metrics(
    relations: Relations,
    start: date | None = None,
    end: date | None = None,
    page: PageRequest = PageRequest("pickup_date"),
) -> Page:
    rows = in_dates(_relation(relations, "mart_revenue_metrics"), start, end)
    return page_of(rows, page, _same(REVENUE_SORTS), ("pickup_date", "payment_type"), rows, "revenue metrics")


def zones(relations: Relations, page: PageRequest = PageRequest("zone_id")) -> Page:
    """Every zone with its pickup demand; zones without pickups show zero and no mean distance."""
    dimension = _relation(relations, "dim_zone")
    demand = _relation(relations, "mart_zone_demand")
    listed = dimension.join(demand, "zone_id", "left").select(
        "zone_id",
        "borough",
        "zone_name",
        "service_zone",
        "is_airport_zone",
        F.coalesce("pickup_trip_count", F.lit(0)).cast("bigint").alias("pickup_trip_count"),
        F.coalesce("passenger_count", F.lit(0.0)).alias("passenger_count"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        "average_trip_distance",
    )
    return page_of(listed, page, _same(ZONE_SORTS), ("zone_id",), dimension, "zones")


def zone_summary(
    relations: Relations, zone_id: int, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Zone attributes beside its trip totals; totals are zero for an unused zone."""
    zone = zone_lookup(relations, zone_id)
    fields = _relation(relations, "dim_zone").schema.fields
    attributes = [F.lit(zone[f.name]).cast(f.dataType).alias(f.name) for f in fields]
    totals = zone_totals(in_dates(_by_route(relations), start, end), zone_id)
    return totals.select(*attributes, "*")


def _named_ends(relations: Relations, rows: DataFrame) -> DataFrame:
    """Attach both zone names; the zone dimension is small and joined under two names."""
    zone = _relation(relations, "dim_zone")
    pickup = zone.select(F.col("zone_id").alias("pickup_zone_id"), F.col("zone_name").alias("pickup_zone_name"))
    dropoff = zone.select(
        F.col("zone_id").alias("dropoff_zone_id"), F.col("zone_name").alias("dropoff_zone_name")
    )
    return rows.join(pickup, "pickup_zone_id").join(dropoff, "dropoff_zone_id")


def top_dropoff_zones(relations: Relations, page: PageRequest = PageRequest("dropoff_trip_count", "desc")) -> Page:
    """Zones by arriving trips, from the route rollup; zones without arrivals show zero."""
    arrived = arrivals_by_zone(_by_route(relations))
    zones = _relation(relations, "dim_zone").select("zone_id", "borough", "zone_name")
    rows = zones.join(arrived, "zone_id", "left").withColumn("dropoff_trip_count", F.coalesce("dropoff_trip_count", F.lit(0)))
    rows = rows.withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0.0)))
    return page_of(rows, page, _same(DROPOFF_SORTS), ("zone_id",), zones, "zones")


def top_routes(
    relations: Relations,
    zone_id: int | None = None,
    page: PageRequest = PageRequest("trip_count", "desc"),
) -> Page:
    """Routes with zone names. The total counts routes before names are attached."""
    if zone_id is not None:
        zone_lookup(relations, zone_id)
    routes = at_zone(_relation(relations, "mart_route_metrics"), zone_id)
    named = _named_ends(relations, routes).select(
        "pickup_zone_id",
        "pickup_zone_name",
        "dropoff_zone_id",
        "dropoff_zone_name",
        "trip_count",
        "average_trip_distance",
        "average_duration_minutes",
        "total_revenue",
    )
    return page_of(named, page, _same(ROUTE_SORTS), ("pickup_zone_id", "dropoff_zone_id"), routes, "route metrics")


def anomalies(
    relations: Relations,
    start: date | None = None,
    end: date | None = None,
    zone_id: int | None = None,
    page: PageRequest = PageRequest("pickup_datetime", "desc"),
) -> Page:
    """Unusual trips with zone names. The total counts trips before names are attached."""
    if zone_id is not None:
        zone_lookup(relations, zone_id)
    trips = at_zone(in_dates(_relation(relations, "mart_anomalous_trips"), start, end), zone_id)
    named = _named_ends(relations, trips).select(
        "trip_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_zone_id",
        "pickup_zone_name",
        "dropoff_zone_id",
        "dropoff_zone_name",
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "total_amount",
        "duration_minutes",
        "average_speed_mph",
        "revenue_per_mile",
        "is_airport_trip",
        "quality_status",
        "quality_reasons",
    )
    return page_of(named, page, _same(ANOMALY_SORTS), ("trip_id",), trips, "anomalous trips")


def daily_export(relations: Relations, start: date | None = None, end: date | None = None) -> DataFrame:
    """All rows of the daily CSV, in date order; however many days the range holds, none is left out."""
    return in_dates(_relation(relations, "mart_daily_trip_metrics"), start, end).orderBy("pickup_date")


def write_daily_csv(
    relations: Relations, folder: str, start: date | None = None, end: date | None = None
) -> None:
    """Write the daily export as one CSV file with a header; nothing to export is an error."""
    if in_dates(_relation(relations, "mart_daily_trip_metrics"), start, end).isEmpty():
        raise EmptyResult("no daily metrics for the given filters")
    rows = daily_export(relations, start, end)
    rows.coalesce(1).write.mode("overwrite").csv(folder, header=True)


def _fact_figures(relations: Relations) -> DataFrame:
    """Counts, dates and newest stamp of the fact; where the time rollup is stored, no trip is read for them."""
    if "time_rollup" in relations:
        return fact_figures(relations["time_rollup"], SERVICES[0])
    return fact_figures(time_rollup(_relation(relations, "fct_trips"), "service"), SERVICES[0])


def row_counts(relations: Relations, names: tuple[str, ...] = KEY_RELATIONS) -> DataFrame:
    """Rows per relation, as (relation, row_count)."""
    counts = [
        _fact_figures(relations).select(F.lit(name).alias("relation"), F.col("trips").alias("row_count"))
        if name == "fct_trips"
        else _relation(relations, name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("relation"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def metadata(relations: Relations) -> DataFrame:
    """Service, its state, covered dates and a row count per key relation, in one row."""
    _relation(relations, "fct_trips")
    figures = _fact_figures(relations)
    of_fact = [F.struct(F.lit(label).alias("relation"), F.col(name).alias("row_count")) for label, name in (("fct_trips", "trips"), ("of_service", "of_service"))]
    facts = figures.select("first", "last", F.inline(F.array(*of_fact)))
    others = tuple(name for name in KEY_RELATIONS if name != "fct_trips")
    facts = facts.unionByName(row_counts(relations, others), allowMissingColumns=True)

    def rows(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("relation") == name, F.col("row_count"))), F.lit(0))

    return facts.agg(
        F.lit(SERVICES[0]).alias("service"),
        F.when(rows("of_service") > 0, "available").otherwise("empty").alias("service_status"),
        F.min("first").alias("start_date"),
        F.max("last").alias("end_date"),
        *[rows(name).alias(f"{name}_rows") for name in KEY_RELATIONS],
    )


def freshness(relations: Relations) -> DataFrame:
    return _fact_figures(relations).select(F.col("newest").alias("data_freshness"))


def readiness(relations: Relations) -> DataFrame:
    """Whether all relations exist and trips and zones are filled; an empty mart is acceptable."""
    missing = [name for name in KEY_RELATIONS if name not in relations]
    present = tuple(name for name in KEY_RELATIONS if name in relations)
    must_have_rows = F.col("relation").isin("fct_trips", "dim_zone")
    filled = F.min(F.when(must_have_rows, F.col("row_count") > 0))
    return row_counts(relations, present).agg(
        F.sum("row_count").alias("total_rows"),
        F.count("*").alias("relations_present"),
        (F.coalesce(filled, F.lit(False)) & F.lit(not missing)).alias("analytics_ready"),
    )


def payment_label(payment_types: DataFrame, rows: DataFrame) -> DataFrame:
    """Add payment_label: the type's name, or "Type n" for unlisted types and for type 0."""
    named = payment_types.where("payment_type <> 0")
    fallback = F.concat(F.lit("Type "), F.col("payment_type").cast("string"))
    return (
        rows.join(named, "payment_type", "left")
        .withColumn("payment_label", F.coalesce("payment_type_name", fallback))
        .drop("payment_type_name")
    )


def route_label() -> Column:
    return F.concat(F.col("pickup_zone_name"), F.lit(" to "), F.col("dropoff_zone_name"))


def zone_label() -> Column:
    return F.concat(F.col("zone_id").cast("string"), F.lit(": "), F.col("zone_name"))


def revenue_label() -> Column:
    return F.concat(F.col("pickup_date").cast("string"), F.lit(" / "), F.col("payment_label"))


def dashboard(
    relations: Relations, limit: int = DEFAULT_LIMIT, start: date | None = None, end: date | None = None
) -> dict[str, Page]:
    """The standing lists of the dashboard, all sharing one row limit and date range."""
    hours = max(24, limit)
    return {
        "daily": daily_metrics(relations, start, end, PageRequest("pickup_date", limit=limit)),
        "hourly": hourly_demand(relations, start, end, PageRequest("pickup_hour", limit=hours)),
        "revenue": revenue_metrics(relations, start, end, PageRequest("pickup_date", limit=limit)),
        "zones": zones(relations, PageRequest("pickup_trip_count", "desc", limit=limit)),
        "routes": top_routes(relations, None, PageRequest("trip_count", "desc", limit=limit)),
        "anomalies": anomalies(relations, start, end, None, PageRequest("pickup_datetime", "desc", limit=limit)),
    }
