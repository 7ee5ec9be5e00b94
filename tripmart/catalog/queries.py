"""One named query per operator. Means and sums are rounded so that engines can be compared."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.store import driver_history, driver_relations, driver_warehouse, new_folder, stored_trips
from tripmart.config import MONTH_COLUMNS
from tripmart.operators import classify as c
from tripmart.operators import reports, summary
from tripmart.operators.checks import run_checks, standard_checks
from tripmart.operators.ordinals import file_counts, file_offsets, with_global_ordinal
from tripmart.operators.paging import PageRequest, index_pages
from tripmart.operators.profile import profile_columns
from tripmart.operators.ranking import hot_records, rank_copies, survey_days, survey_months, with_record_hash
from tripmart.plans import models, serving
from tripmart.plans.pipeline import replace_months
from tripmart.plans.warehouse import Warehouse, period_of
from tripmart.sources.driver_tables import DRIVER_INGESTED_AT, DRIVER_RULES, driver_trips, driver_zone_lookup
from tripmart.sources.files import table_files
from tripmart.sources.schema import CLASSIFIED_SCHEMA, LINEAGE_COLUMNS, TRIP_COLUMNS, conform
from tripmart.sources.summaries import newest_summary, read_summaries, write_summaries
from tripmart.sources.trips import first_rows
from tripmart.sources.zones import zone_ids, zone_table
from tripmart.streaming.arrivals import ingest_arrivals

Query = Callable[[SparkSession, str], DataFrame]

TYPED = [column.name for column in TRIP_COLUMNS]
MEASURES = ["duration_minutes", "average_speed_mph", "revenue_per_mile"]
PARTITION_FREE = [name for name in CLASSIFIED_SCHEMA.names if name not in MONTH_COLUMNS]

# Parameters of the registered queries.
ZONE = 5
START, END = date(1997, 1, 1), date(1997, 12, 31)
SAMPLE_ROWS = 1000
# Two copies are hot enough to be split, and slices are shorter than the distance of copies.
HOT_ROWS, SLICE = 2, 1
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Columns that are sums (compared to the cent) and means (compared to six digits).
SUMS = {
    "total_revenue", "fare_revenue", "tip_revenue", "tolls_revenue", "trip_distance", "passenger_count",
    "total_distance",
}


def comparable(frame: DataFrame) -> DataFrame:
    """Round aggregated sums and means; a tiny nudge keeps exact ties from rounding apart."""
    def column(name: str):
        if name.startswith("average_") or name.endswith("_avg"):
            return F.round(F.col(name) + 1e-9, 6).alias(name)
        return F.round(name, 2).alias(name) if name in SUMS else F.col(name)

    return frame.select(*[column(name) for name in frame.columns])


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(driver_trips(spark, sf_dir))


def _zone_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_ids(driver_zone_lookup(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = stored_trips(spark, sf_dir)
    return _judged(trips, _zone_ids(spark, sf_dir))


def _judged(trips: DataFrame, ids: DataFrame) -> DataFrame:
    surveys = survey_months(trips)
    return c.classify(trips, ids, DRIVER_RULES, DRIVER_INGESTED_AT, hot_records(surveys), days=survey_days(trips, surveys))


class RoundedMarts(Mapping[str, DataFrame]):
    """Relations with rounded marts, so that sort keys agree between engines."""

    def __init__(self, relations: Mapping[str, DataFrame]) -> None:
        self._relations = relations

    def __getitem__(self, name: str) -> DataFrame:
        relation = self._relations[name]
        return comparable(relation) if name in serving.ROLLED_UP_MARTS else relation

    def __iter__(self) -> Iterator[str]:
        return iter(self._relations)

    def __len__(self) -> int:
        return len(self._relations)


def _served(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return RoundedMarts(driver_relations(spark, sf_dir))


# --- from raw trips to classified rows ---------------------------------------------------------


def normalized_trips(spark, sf_dir):
    return _trips(spark, sf_dir).select("source_row_number", *TYPED)


def measured_trips(spark, sf_dir):
    return c.with_measures(_trips(spark, sf_dir)).select("source_row_number", *TYPED, *MEASURES)


def record_hash(spark, sf_dir):
    return with_record_hash(_trips(spark, sf_dir)).select("source_row_number", "stable_record_hash")


def duplicate_rank(spark, sf_dir):
    trips = stored_trips(spark, sf_dir)
    surveys = survey_months(trips)
    ranked = rank_copies(trips, hot_records(surveys), days=survey_days(trips, surveys))
    return ranked.select("stable_record_hash", "source_row_number", "duplicate_rank")


def duplicate_rank_split(spark, sf_dir):
    """The same ranks with every repeated record treated as hot and split into slices."""
    trips = stored_trips(spark, sf_dir)
    surveys = survey_months(trips, hot_group_rows=HOT_ROWS)
    ranked = rank_copies(trips, hot_records(surveys), slice_rows=SLICE, days=survey_days(trips, surveys))
    return ranked.select("stable_record_hash", "source_row_number", "duplicate_rank")


def classified_trips(spark, sf_dir):
    return _classified(spark, sf_dir)


def validated_trips(spark, sf_dir):
    return c.loadable(_classified(spark, sf_dir)).drop(*MONTH_COLUMNS)


def rejected_trips(spark, sf_dir):
    return driver_warehouse(spark, sf_dir).outcome("rejected").drop(*MONTH_COLUMNS)


def status_counts(spark, sf_dir):
    return summary.status_counts(driver_warehouse(spark, sf_dir).classified())


def rule_counts(spark, sf_dir):
    return summary.rule_counts(driver_warehouse(spark, sf_dir).classified())


def validation_summary(spark, sf_dir):
    """The stored rows, summarised and flattened to one row per month and rule."""
    rows = summary.validation_summary(driver_warehouse(spark, sf_dir).classified())
    return rows.select(
        "service",
        "year",
        "month",
        "validated_at",
        "total_rows",
        *[F.col(f"status_counts.{name}").alias(f"{name}_rows") for name in c.STATUSES],
        F.explode("rule_counts").alias("rule", "rule_rows"),
    )


def raw_profile(spark, sf_dir):
    return comparable(profile_columns(driver_trips(spark, sf_dir)))


def bounded_sample(spark, sf_dir):
    """The first rows in row order; rows that share a number are told apart by content."""
    hashed = with_record_hash(_trips(spark, sf_dir))
    sample = first_rows(hashed, SAMPLE_ROWS, "source_row_number", "stable_record_hash")
    return sample.select("source_row_number", *TYPED)


# --- zones, staging and models -------------------------------------------------------------------


def zones_load(spark, sf_dir):
    return zone_table(driver_zone_lookup(spark, sf_dir))


def staging_trips(spark, sf_dir):
    return driver_warehouse(spark, sf_dir).staging()


def _relation(name: str) -> Query:
    return lambda spark, sf_dir: driver_relations(spark, sf_dir)[name]


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: comparable(driver_relations(spark, sf_dir)[name])


def _usage(dimension: str, key: str) -> Query:
    """A fixed dimension beside the trips that use each member; unused members show zero."""

    def run(spark, sf_dir):
        relations = driver_relations(spark, sf_dir)
        member = relations[dimension].columns[0]
        used = relations["fct_trips"].groupBy(F.col(key).alias(member)).agg(F.count("*").alias("n"))
        joined = relations[dimension].join(used, member, "left")
        return joined.select(*relations[dimension].columns, F.coalesce("n", F.lit(0)).alias("trip_count"))

    return run


# --- data checks -----------------------------------------------------------------------------------


def _checks(test: str) -> Query:
    def run(spark, sf_dir):
        wanted = [check for check in standard_checks(DRIVER_RULES) if check.test == test]
        return run_checks(driver_relations(spark, sf_dir), wanted)

    return run


# --- served queries --------------------------------------------------------------------------------


def overview(spark, sf_dir):
    return comparable(serving.overview(driver_relations(spark, sf_dir)))


def overview_zone(spark, sf_dir):
    return comparable(serving.overview(driver_relations(spark, sf_dir), START, END, ZONE))


def daily_metrics_page(spark, sf_dir):
    page = PageRequest("total_revenue", "desc", limit=15, offset=5)
    return serving.daily_metrics(_served(spark, sf_dir), page=page).items


def daily_metrics_range(spark, sf_dir):
    """Every day of the range, unpaged."""
    return serving.daily_export(_served(spark, sf_dir), START, END)


def hourly_demand_page(spark, sf_dir):
    page = PageRequest("trip_count", "desc", limit=50, offset=10)
    return serving.hourly_demand(_served(spark, sf_dir), page=page).items


def revenue_page(spark, sf_dir):
    page = PageRequest("total_revenue", "desc", limit=40, offset=3)
    return serving.revenue_metrics(_served(spark, sf_dir), START, END, page).items


def revenue_labeled(spark, sf_dir):
    relations = driver_relations(spark, sf_dir)
    rows = comparable(relations["mart_revenue_metrics"]).select("pickup_date", "payment_type", "total_revenue")
    labeled = serving.payment_label(relations["dim_payment_type"], rows)
    return labeled.withColumn("label", serving.revenue_label())


def zones(spark, sf_dir):
    page = PageRequest("total_revenue", "desc", limit=20, offset=2)
    return serving.zones(_served(spark, sf_dir), page).items


def zones_labeled(spark, sf_dir):
    page = serving.zones(_served(spark, sf_dir), PageRequest("pickup_trip_count", "desc", limit=10))
    return page.items.select("zone_id", serving.zone_label().alias("label"), "pickup_trip_count")


def zone_summary(spark, sf_dir):
    return comparable(serving.zone_summary(driver_relations(spark, sf_dir), ZONE, START, END))


def top_routes(spark, sf_dir):
    return serving.top_routes(_served(spark, sf_dir), ZONE, PageRequest("trip_count", "desc", limit=30)).items


def top_routes_labeled(spark, sf_dir):
    page = serving.top_routes(_served(spark, sf_dir), page=PageRequest("trip_count", "desc", limit=25, offset=5))
    return page.items.select(serving.route_label().alias("route_label"), "trip_count", "total_revenue")


def anomalies(spark, sf_dir):
    page = PageRequest("pickup_datetime", "desc", limit=100, offset=20)
    return serving.anomalies(driver_relations(spark, sf_dir), page=page).items


def anomalies_by_speed(spark, sf_dir):
    page = PageRequest("average_speed_mph", "asc", limit=500, offset=100)
    return serving.anomalies(driver_relations(spark, sf_dir), START, END, page=page).items


def page_totals(spark, sf_dir):
    """Totals that accompany the pages, counted before names are attached."""
    relations = driver_relations(spark, sf_dir)
    pages = {
        "daily": serving.daily_metrics(relations, START, END),
        "hourly": serving.hourly_demand(relations, START, END),
        "revenue": serving.revenue_metrics(relations, START, END),
        "zones": serving.zones(relations),
        "routes": serving.top_routes(relations, ZONE),
        "anomalies": serving.anomalies(relations, START, END, ZONE),
    }
    return serving.row_counts({name: page.counted for name, page in pages.items()}, tuple(pages)).select(
        F.col("relation").alias("list"), F.col("row_count").alias("total")
    )


def anomalies_third_page(spark, sf_dir):
    """The third page, reached by the tokens of the two before it."""
    request = PageRequest("total_amount", "desc", limit=40)
    for _ in range(2):
        page = serving.anomalies(driver_relations(spark, sf_dir), page=request)
        request = replace(request, after=page.next_token)
    return serving.anomalies(driver_relations(spark, sf_dir), page=request).items


def anomaly_page_starts(spark, sf_dir):
    """First row of each page of all unusual trips by distance; many share a distance."""
    page = serving.anomalies(driver_relations(spark, sf_dir), page=PageRequest("trip_distance", "desc", limit=25))
    return index_pages(page).starts


def anomalies_last_page(spark, sf_dir):
    """The last page of all unusual trips by distance, through the index of page starts."""
    relations = driver_relations(spark, sf_dir)
    index = index_pages(serving.anomalies(relations, page=PageRequest("trip_distance", "desc", limit=25)))
    last = index.starts.agg(F.max("page")).first()[0]
    return serving.anomalies(relations, page=index.request_for(last)).items


def _dashboard(name: str) -> Query:
    return lambda spark, sf_dir: serving.dashboard(_served(spark, sf_dir), limit=20)[name].items


def daily_export(spark, sf_dir):
    return serving.daily_export(_served(spark, sf_dir), START, END)


def metadata(spark, sf_dir):
    return serving.metadata(driver_relations(spark, sf_dir))


def freshness(spark, sf_dir):
    return serving.freshness(driver_relations(spark, sf_dir))


def readiness(spark, sf_dir):
    return serving.readiness(driver_relations(spark, sf_dir))


# --- history, files and arrivals ---------------------------------------------------------------------


def latest_quality_summary(spark, sf_dir):
    """Summaries of every order month, written as documents and read back; the newest wins."""
    trips = stored_trips(spark, sf_dir, by_order_month=True)
    classified = _judged(trips, _zone_ids(spark, sf_dir))
    folder = new_folder(spark, "summary-history", sf_dir)
    write_summaries(summary.validation_summary(classified), folder)
    return newest_summary(read_summaries(spark, folder)).select(
        "service",
        "year",
        "month",
        "validated_at",
        "total_rows",
        *[F.col(f"status_counts.{name}").alias(f"{name}_rows") for name in c.STATUSES],
        F.aggregate(F.map_values("rule_counts"), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("rule_hits"),
        "artifact_name",
        "well_formed",
    )


def backfill_months(spark, sf_dir):
    """Many months replaced in one run: rows per month and status from the stored table."""
    warehouse = Warehouse(spark, new_folder(spark, "backfill", sf_dir), DRIVER_RULES)
    trips = stored_trips(spark, sf_dir, by_order_month=True)
    replace_months(trips, driver_zone_lookup(spark, sf_dir), warehouse, DRIVER_INGESTED_AT)
    stored = warehouse.classified()
    return stored.groupBy(*MONTH_COLUMNS, "quality_status").agg(
        F.count("*").alias("row_count"), F.countDistinct("trip_id").alias("trip_ids")
    )


def incremental_ingest(spark, sf_dir):
    """Raw month folders picked up by the streaming job; the staged rows it leaves behind."""
    raw, state = new_folder(spark, "arrivals", sf_dir), new_folder(spark, "arrivals-state", sf_dir)
    trips = driver_trips(spark, sf_dir).drop(*LINEAGE_COLUMNS)
    quarter = F.coalesce(F.quarter("tpep_pickup_datetime"), F.quarter("tpep_dropoff_datetime"), F.lit(1))
    placed = trips.withColumns(
        {"service": F.lit("yellow"), "source_year": F.lit(2026), "source_month": quarter}
    )
    placed.write.mode("overwrite").partitionBy(*MONTH_COLUMNS).parquet(raw)
    warehouse = Warehouse(spark, new_folder(spark, "arrivals-warehouse", sf_dir), DRIVER_RULES)
    run = ingest_arrivals(
        spark, raw, state, lambda: driver_zone_lookup(spark, sf_dir), warehouse, lambda: DRIVER_INGESTED_AT
    )
    run.awaitTermination()
    return warehouse.staging().drop("source_row_number", "source_file")


def row_ordinals(spark, sf_dir):
    """Line items written as ten files, numbered without gap over all of them in path order."""
    folder = new_folder(spark, "ordinal-files", sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 10).alias("file"))
    lines.repartition("file").sortWithinPartitions("file", "l_orderkey", "l_linenumber").write.mode("overwrite").partitionBy("file").parquet(folder)
    place = [F.col("_metadata.file_path").alias("source_file"), (F.col("_metadata.row_index") + 1).alias("source_row_number")]
    rows = spark.read.parquet(folder).select("l_orderkey", "l_linenumber", *place)
    offsets = file_offsets(file_counts(rows), files_per_range=3)
    return with_global_ordinal(rows, offsets, "ordinal").select("l_orderkey", "l_linenumber", "ordinal")


def late_file_parts(spark, sf_dir):
    """Pickup months of the daily mart, and which of them late rows of the newest order month had rewritten."""
    warehouse, before = driver_history(spark, sf_dir)
    now, mart = warehouse.at(), "mart_daily_trip_metrics"
    old = warehouse.at(before).snapshot.parts(mart)
    rewritten = [int(part) for part, commit in now.snapshot.parts(mart).items() if old.get(part) != commit]
    days = now.stored(mart).groupBy(period_of().alias("period")).agg(F.count("*").alias("days"))
    return days.select("period", "days", F.col("period").isin(rewritten).alias("rewritten"))


def previous_snapshot(spark, sf_dir):
    """The daily mart as it was before the late rows, read after they were loaded."""
    warehouse, before = driver_history(spark, sf_dir)
    daily = warehouse.at(before).stored("mart_daily_trip_metrics")
    return comparable(daily.select("pickup_date", "trip_count", "passenger_count", "total_revenue"))


def table_files_query(spark, sf_dir):
    return table_files(spark, sf_dir, TABLES)


# --- further reports -----------------------------------------------------------------------------------


def top_dropoff_zones(spark, sf_dir):
    return comparable(serving.top_dropoff_zones(driver_relations(spark, sf_dir), PageRequest("dropoff_trip_count", "desc", limit=20)).items)


def anomaly_flags(spark, sf_dir):
    return reports.anomaly_flags(driver_warehouse(spark, sf_dir).classified())


def rejected_summary(spark, sf_dir):
    return reports.rejected_summary(driver_warehouse(spark, sf_dir).classified())


def out_of_month(spark, sf_dir):
    return reports.out_of_month(conform(driver_trips(spark, sf_dir, by_order_month=True)))


def schema_drift(spark, sf_dir):
    """Trips whose fares and passengers come as text with values that are no numbers."""
    row = F.col("source_row_number")
    raw = driver_trips(spark, sf_dir).withColumns(
        {
            "fare_amount": F.when(row % 17 == 0, "n/a").otherwise(F.col("fare_amount").cast("string")),
            "passenger_count": F.when(row % 19 == 0, "two").otherwise(F.col("passenger_count").cast("string")),
        }
    )
    return reports.schema_drift(raw.drop("airport_fee"))


QUERIES: dict[str, Query] = {
    "normalized_trips": normalized_trips,
    "measured_trips": measured_trips,
    "record_hash": record_hash,
    "duplicate_rank": duplicate_rank,
    "classified_trips": classified_trips,
    "validated_trips": validated_trips,
    "rejected_trips": rejected_trips,
    "status_counts": status_counts,
    "rule_counts": rule_counts,
    "validation_summary": validation_summary,
    "raw_profile": raw_profile,
    "bounded_sample": bounded_sample,
    "zones_load": zones_load,
    "staging_trips": staging_trips,
    "stg_trips": _relation("stg_trips"),
    "stg_zones": _relation("stg_zones"),
    "dim_zone": _relation("dim_zone"),
    "dim_date": _relation("dim_date"),
    "dim_hour": _usage("dim_hour", "pickup_hour"),
    "dim_payment_type": _usage("dim_payment_type", "payment_type"),
    "dim_rate_code": _usage("dim_rate_code", "rate_code_id"),
    "fct_trips": _relation("fct_trips"),
    "mart_daily_trip_metrics": _mart("mart_daily_trip_metrics"),
    "mart_hourly_demand": _mart("mart_hourly_demand"),
    "mart_zone_demand": _mart("mart_zone_demand"),
    "mart_route_metrics": _mart("mart_route_metrics"),
    "mart_revenue_metrics": _mart("mart_revenue_metrics"),
    "mart_anomalous_trips": _relation("mart_anomalous_trips"),
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_accepted_values": _checks("accepted_values"),
    "dq_relationships": _checks("relationships"),
    "dq_non_negative": _checks("non_negative"),
    "dq_valid_duration": _checks("valid_duration"),
    "dq_reasonable_speed": _checks("reasonable_speed"),
    "overview": overview,
    "overview_zone": overview_zone,
    "daily_metrics_page": daily_metrics_page,
    "daily_metrics_range": daily_metrics_range,
    "hourly_demand_page": hourly_demand_page,
    "revenue_page": revenue_page,
    "revenue_labeled": revenue_labeled,
    "zones": zones,
    "zones_labeled": zones_labeled,
    "zone_summary": zone_summary,
    "top_routes": top_routes,
    "top_routes_labeled": top_routes_labeled,
    "anomalies": anomalies,
    "anomalies_by_speed": anomalies_by_speed,
    "page_totals": page_totals,
    "anomalies_third_page": anomalies_third_page,
    "anomaly_page_starts": anomaly_page_starts,
    "anomalies_last_page": anomalies_last_page,
    "dashboard_daily": _dashboard("daily"),
    "dashboard_hourly": _dashboard("hourly"),
    "dashboard_revenue": _dashboard("revenue"),
    "dashboard_zones": _dashboard("zones"),
    "dashboard_routes": _dashboard("routes"),
    "dashboard_anomalies": _dashboard("anomalies"),
    "daily_export": daily_export,
    "metadata": metadata,
    "freshness": freshness,
    "readiness": readiness,
    "latest_quality_summary": latest_quality_summary,
    "backfill_months": backfill_months,
    "incremental_ingest": incremental_ingest,
    "row_ordinals": row_ordinals,
    "late_file_parts": late_file_parts,
    "previous_snapshot": previous_snapshot,
    "table_files": table_files_query,
    "top_dropoff_zones": top_dropoff_zones,
    "anomaly_flags": anomaly_flags,
    "rejected_summary": rejected_summary,
    "out_of_month": out_of_month,
    "schema_drift": schema_drift,
    "duplicate_rank_split": duplicate_rank_split,
}
