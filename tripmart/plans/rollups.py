"""Two additive rollups of the fact, and the marts and totals that derive from them.

The fact is scanned once per rollup and month. Sums and counts are kept side by side, so the
marts, date-ranged overviews and zone summaries re-add small tables instead of reading trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.trip import ratio

# What each rollup is keyed by, besides the source month in the stored form.
TIME_KEYS = ("pickup_date", "pickup_hour", "payment_type")
ROUTE_KEYS = ("pickup_date", "pickup_zone_id", "dropoff_zone_id")

# Added-up trip columns, and those among them whose mean is served (their counts are kept too).
SUMMED = {
    "passengers": "passenger_count",
    "miles": "trip_distance",
    "fares": "fare_amount",
    "tips": "tip_amount",
    "tolls": "tolls_amount",
    "revenue": "total_amount",
    "minutes": "duration_minutes",
    "speeds": "average_speed_mph",
    "yields": "revenue_per_mile",
}
AVERAGED = ("miles", "fares", "minutes", "speeds", "yields")
COUNTERS = ("trips", "airport_trips", "warned_trips", *(f"{name}_n" for name in AVERAGED))


def _rollup(trips: DataFrame, keys: tuple[str, ...], *more: Column) -> DataFrame:
    measures = [F.count("*").alias("trips"), *more]
    measures += [F.sum(column).alias(name) for name, column in SUMMED.items()]
    measures += [F.count(SUMMED[name]).alias(f"{name}_n") for name in AVERAGED]
    measures.append(F.count_if("is_airport_trip").alias("airport_trips"))
    measures.append(F.count_if(F.col("quality_status") == "warning").alias("warned_trips"))
    return trips.groupBy(*keys).agg(*measures)


def time_rollup(trips: DataFrame, *month_columns: str) -> DataFrame:
    return _rollup(trips, (*month_columns, *TIME_KEYS), F.max("ingested_at").alias("newest"))


def fact_figures(by_time: DataFrame, service: str) -> DataFrame:
    """One row on the fact, from its time rollup: trips, trips of the service, first and last date, newest stamp."""
    return by_time.agg(
        F.coalesce(F.sum("trips"), F.lit(0).cast("bigint")).alias("trips"),
        F.coalesce(F.sum(F.when(F.col("service") == service, F.col("trips"))), F.lit(0).cast("bigint")).alias("of_service"),
        F.min("pickup_date").alias("first"),
        F.max("pickup_date").alias("last"),
        F.max("newest").alias("newest"),
    )


def route_rollup(trips: DataFrame, *month_columns: str) -> DataFrame:
    return _rollup(trips, (*month_columns, *ROUTE_KEYS))


def route_months(by_route: DataFrame, *month_columns: str) -> DataFrame:
    """The route rollup added up over dates."""
    measures = [name for name in by_route.columns if name not in (*month_columns, *ROUTE_KEYS)]
    return by_route.groupBy(*month_columns, "pickup_zone_id", "dropoff_zone_id").agg(*added(*measures))


def added(*names: str) -> list[Column]:
    """Re-aggregate rollup measures by name."""
    return [F.sum(name).alias(name) for name in names]


def _mean(name: str) -> Column:
    return ratio(name, f"{name}_n")


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def mart_daily(by_time: DataFrame) -> DataFrame:
    sums = added(
        "trips", "passengers", "miles", "revenue", "minutes", "minutes_n", "speeds", "speeds_n", "airport_trips"
    )
    return by_time.groupBy("pickup_date").agg(*sums).select(
        "pickup_date",
        F.col("trips").alias("trip_count"),
        _or_zero("passengers").alias("passenger_count"),
        F.col("miles").alias("trip_distance"),
        F.col("revenue").alias("total_revenue"),
        _mean("minutes").alias("average_duration_minutes"),
        _mean("speeds").alias("average_speed_mph"),
        F.col("airport_trips").alias("airport_trip_count"),
    )


def mart_hourly(by_time: DataFrame) -> DataFrame:
    sums = added("trips", "passengers", "minutes", "minutes_n", "revenue")
    return by_time.groupBy("pickup_date", "pickup_hour").agg(*sums).select(
        "pickup_date",
        "pickup_hour",
        F.col("trips").alias("trip_count"),
        _or_zero("passengers").alias("passenger_count"),
        _mean("minutes").alias("average_duration_minutes"),
        F.col("revenue").alias("total_revenue"),
    )


def mart_revenue(by_time: DataFrame) -> DataFrame:
    sums = added("trips", "fares", "tips", "tolls", "revenue", "yields", "yields_n")
    return by_time.groupBy("pickup_date", "payment_type").agg(*sums).select(
        "pickup_date",
        "payment_type",
        F.col("trips").alias("trip_count"),
        F.col("fares").alias("fare_revenue"),
        F.col("tips").alias("tip_revenue"),
        F.col("tolls").alias("tolls_revenue"),
        F.col("revenue").alias("total_revenue"),
        _mean("yields").alias("average_revenue_per_mile"),
    )


def mart_zone(by_route: DataFrame) -> DataFrame:
    sums = added("trips", "passengers", "revenue", "miles", "miles_n")
    return by_route.groupBy("pickup_zone_id").agg(*sums).select(
        F.col("pickup_zone_id").alias("zone_id"),
        F.col("trips").alias("pickup_trip_count"),
        _or_zero("passengers").alias("passenger_count"),
        F.col("revenue").alias("total_revenue"),
        _mean("miles").alias("average_trip_distance"),
    )


def arrivals_by_zone(by_route: DataFrame) -> DataFrame:
    return by_route.groupBy("dropoff_zone_id").agg(*added("trips", "revenue")).select(
        F.col("dropoff_zone_id").alias("zone_id"),
        F.col("trips").alias("dropoff_trip_count"),
        F.col("revenue").alias("total_revenue"),
    )


def mart_route(by_route: DataFrame) -> DataFrame:
    sums = added("trips", "miles", "miles_n", "minutes", "minutes_n", "revenue")
    return by_route.groupBy("pickup_zone_id", "dropoff_zone_id").agg(*sums).select(
        "pickup_zone_id",
        "dropoff_zone_id",
        F.col("trips").alias("trip_count"),
        _mean("miles").alias("average_trip_distance"),
        _mean("minutes").alias("average_duration_minutes"),
        F.col("revenue").alias("total_revenue"),
    )


def overview_totals(rollup: DataFrame) -> DataFrame:
    """Key figures over whatever rows of a rollup are passed; zeros when there are none."""
    sums = added(
        "trips", "revenue", "fares", "fares_n", "minutes", "minutes_n", "miles", "airport_trips", "warned_trips"
    )

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    return rollup.agg(*sums).select(
        whole("trips").alias("total_trips"),
        _or_zero("revenue").alias("total_revenue"),
        F.coalesce(_mean("fares"), F.lit(0.0)).alias("average_fare"),
        F.coalesce(_mean("minutes"), F.lit(0.0)).alias("average_duration_minutes"),
        _or_zero("miles").alias("total_distance"),
        whole("airport_trips").alias("airport_trip_count"),
        whole("warned_trips").alias("warning_trip_count"),
    )


def zone_totals(by_route: DataFrame, zone_id: int) -> DataFrame:
    """Trips that start, end or touch a zone; a trip inside the zone counts once as related."""
    starts, ends = F.col("pickup_zone_id") == zone_id, F.col("dropoff_zone_id") == zone_id

    def trips_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("trips"))), F.lit(0).cast("bigint"))

    sums = added("revenue", "miles", "miles_n", "minutes", "minutes_n")
    return by_route.where(starts | ends).agg(
        trips_where(starts).alias("pickup_trip_count"),
        trips_where(ends).alias("dropoff_trip_count"),
        trips_where(starts | ends).alias("related_trip_count"),
        *sums,
    ).select(
        "pickup_trip_count",
        "dropoff_trip_count",
        "related_trip_count",
        _or_zero("revenue").alias("total_revenue"),
        _mean("miles").alias("average_trip_distance"),
        _mean("minutes").alias("average_duration_minutes"),
    )
