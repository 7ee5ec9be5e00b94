"""The run: classify months, replace their partitions, derive rollups, marts and summaries."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import MONTH_COLUMNS, Month, Rules
from tripmart.operators.checks import run_checks, standard_checks
from tripmart.operators.classify import classify
from tripmart.operators.profile import profile_files, write_profile
from tripmart.operators.ranking import HOT_GROUP_ROWS, MonthSurvey, hot_records, in_months, survey_days, survey_months
from tripmart.operators.summary import validation_summary
from tripmart.plans.serving import readiness
from tripmart.plans.warehouse import REJECTED, VALIDATED, Change, Warehouse, by_partition, side_by_side
from tripmart.sources.summaries import write_summaries
from tripmart.sources.trips import month_files, read_month
from tripmart.sources.zones import read_zone_file, zone_ids, zone_table

# Aim for this many rows per written file when one job writes several months.
ROWS_PER_FILE = 5_000_000
FILES_PER_TASK = 16


@dataclass(frozen=True)
class RunReport:
    months: tuple[Month, ...]
    loaded_rows: int
    zone_rows: int


def month_buckets(surveys: Sequence[MonthSurvey], tasks: int) -> Column | None:
    """Into how many buckets each month is split when several are written at once.

    Buckets are in proportion to rows, so a task writes a few month folders and a month that
    holds much of the data is spread over many tasks. A single month is spread freely.
    """
    if len(surveys) < 2:
        return None
    total = sum(survey.rows for survey in surveys)
    rows_per_bucket = max(1, min(ROWS_PER_FILE, math.ceil(total / (FILES_PER_TASK * tasks))))
    buckets = {
        (s.month.service, s.month.year, s.month.month): math.ceil(s.rows / rows_per_bucket) for s in surveys
    }
    return by_partition(MONTH_COLUMNS, buckets, "bigint")


def validate_months(
    trips: DataFrame,
    ids: DataFrame,
    change: Change,
    ingested_at: datetime,
    months: Iterable[Month] = (),
    hot_group_rows: int = HOT_GROUP_ROWS,
) -> list[Month]:
    """Classify all months found in `trips` and replace their validated and rejected rows in `change`.

    `months` adds months that were asked for but have no rows; they end up empty. Both outcomes
    of a month are written by one job from one classification.
    """
    surveys = {survey.month: survey for survey in survey_months(trips, hot_group_rows)}
    wanted = sorted(surveys.keys() | set(months))
    tasks = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    outcome = F.when(F.col("quality_status") == "rejected", REJECTED).otherwise(VALIDATED)
    layout = ("outcome", *MONTH_COLUMNS)
    present = [surveys[month] for month in wanted if month in surveys]
    classified = classify(
        trips, ids, change.rules, ingested_at, hot_records(present), month_buckets(present, tasks), survey_days(trips, present)
    )
    # Sorting inside each task lets later date filters skip row groups.
    sorted_rows = classified.withColumn("outcome", outcome).sortWithinPartitions(*layout, "pickup_datetime")
    change.replace_partitions("trips", sorted_rows, MONTH_COLUMNS, [(m.service, m.year, m.month) for m in wanted], "outcome")
    return wanted


def summarise_months(warehouse: Warehouse, months: Sequence[Month], sources: Mapping[Month, str]) -> None:
    """Write one summary document per month from the stored, classified rows, with its source path and outputs."""
    stored = warehouse.classified().where(in_months(months))
    places = [
        (m.service, m.year, m.month, sources.get(m), (warehouse.month_folder(VALIDATED, m), warehouse.month_folder(REJECTED, m))) for m in months
    ]
    schema = "service string, year int, month int, source_path string, outputs struct<validated: string, rejected: string>"
    documents = validation_summary(stored).join(F.broadcast(warehouse.spark.createDataFrame(places, schema)), ["service", "year", "month"])
    write_summaries(documents, warehouse.path("summaries"))


def replace_months(
    trips: DataFrame,
    zones: DataFrame,
    warehouse: Warehouse,
    ingested_at: datetime,
    months: Iterable[Month] = (),
    hot_group_rows: int = HOT_GROUP_ROWS,
    sources: Mapping[Month, str] | None = None,
) -> RunReport:
    """Bring the warehouse up to date with the given raw months and zone lookup; rerunnable. `sources` names where months come from.

    Readers see the run's tables all at once when it is complete. A run that fails leaves everything as it was.
    """
    ids = zone_ids(zones)  # a bad lookup is refused before anything is written
    change = warehouse.change()
    change.replace_zones(zone_table(zones))
    done = validate_months(trips, ids, change, ingested_at, months, hot_group_rows)
    change.derive_months(done)
    change.refresh_marts(done)
    now = warehouse.at(change.commit())
    summarise_months(now, done, sources or {})
    loaded = now.staging().where(in_months(done)).count()
    return RunReport(tuple(done), loaded, now.zones().count())


@dataclass(frozen=True)
class PipelineConfig:
    """Inputs of a whole run: one raw path per month, the zone lookup and the warehouse root."""

    raw_paths: Mapping[Month, str]
    zone_path: str
    root: str
    ingested_at: datetime
    rules: Rules = field(default_factory=Rules)


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> dict[str, Any]:
    """Profile, validate, load, model and check the given months; returns a small report."""
    profiles = {month: profile_files(spark, month_files(spark, path)) for month, path in config.raw_paths.items()}
    trips = reduce(DataFrame.unionByName, [read_month(spark, p, m) for m, p in config.raw_paths.items()])
    warehouse = Warehouse(spark, config.root, config.rules)
    for month, profile in profiles.items():
        write_profile(spark, profile, warehouse.path(f"profiles/raw_profile_{month.year:04d}_{month.month:02d}_{month.service}"))
    report = replace_months(
        trips, read_zone_file(spark, config.zone_path), warehouse, config.ingested_at, config.raw_paths, sources=config.raw_paths
    )
    relations = warehouse.relations()
    checks = run_checks(relations, standard_checks(config.rules))
    broken = [row.asDict() for row in checks.where("violations > 0").collect()]
    return {
        "profiles": profiles,
        "loaded_rows": report.loaded_rows,
        "zone_rows": report.zone_rows,
        "failed_checks": broken,
        "analytics_ready": readiness(relations).first().analytics_ready,
    }
