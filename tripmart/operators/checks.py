"""Declarative data checks: each counts the rows that break a stated property."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import SERVICES, Rules

LOADED_STATUSES = ("valid", "warning")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    limit: float = 0.0
    parent: str = ""
    parent_column: str = ""


def standard_checks(rules: Rules) -> list[Check]:
    """The full suite over sources, staging, dimensions and the fact."""
    keys = {
        "yellow_trips": "trip_id",
        "taxi_zones": "location_id",
        "stg_trips": "trip_id",
        "stg_zones": "zone_id",
        "dim_zone": "zone_id",
        "dim_date": "date",
        "dim_hour": "hour",
        "dim_payment_type": "payment_type",
        "dim_rate_code": "rate_code_id",
        "fct_trips": "trip_id",
    }
    parents = {
        "pickup_date": ("dim_date", "date"),
        "pickup_hour": ("dim_hour", "hour"),
        "pickup_zone_id": ("dim_zone", "zone_id"),
        "dropoff_zone_id": ("dim_zone", "zone_id"),
        "payment_type": ("dim_payment_type", "payment_type"),
        "rate_code_id": ("dim_rate_code", "rate_code_id"),
    }
    checks = [Check(model, key, test) for model, key in keys.items() for test in ("not_null", "unique")]
    checks += [Check("fct_trips", column, "not_null") for column in list(parents)[:4]]
    checks += [
        Check(model, "service", "accepted_values", values=SERVICES)
        for model in ("yellow_trips", "stg_trips", "fct_trips")
    ]
    checks += [
        Check(model, "quality_status", "accepted_values", values=LOADED_STATUSES)
        for model in ("stg_trips", "fct_trips")
    ]
    checks += [
        Check("fct_trips", column, "relationships", parent=parent, parent_column=key)
        for column, (parent, key) in parents.items()
    ]
    checks += [
        Check("fct_trips", column, "non_negative")
        for column in ("trip_distance", "fare_amount", "total_amount")
    ]
    checks.append(Check("fct_trips", "duration_minutes", "valid_duration", limit=rules.max_duration_minutes))
    checks.append(Check("fct_trips", "average_speed_mph", "reasonable_speed", limit=rules.max_speed_mph))
    return checks


def _broken(check: Check) -> Column:
    value = F.col(check.column)
    if check.test == "not_null":
        return value.isNull()
    if check.test == "accepted_values":
        return ~value.isin(list(check.values))
    if check.test == "non_negative":
        return value.isNull() | (value < 0)
    if check.test == "valid_duration":
        return value.isNull() | (value < 0) | (value > check.limit)
    if check.test == "reasonable_speed":
        return (value < 0) | (value > check.limit)
    raise ValueError(f"unknown row check {check.test!r}")


def _report(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.test).alias("test"),
        violations.alias("violations"),
    )


def unique_key(column: str) -> Column:
    return F.xxhash64(F.col(column))


def _single_pass(model: DataFrame, checks: list[Check], relations: Mapping[str, DataFrame]) -> DataFrame:
    """All row and relationship checks of one model in one scan.

    Parents are dimension keys; a left join marks hits and keeps one row per child row.
    """
    counted = []
    for position, check in enumerate(checks):
        if check.test == "relationships":
            hit = f"_hit_{position}"
            parent = (
                relations[check.parent]
                .select(F.col(check.parent_column).alias(check.column))
                .distinct()
                .withColumn(hit, F.lit(True))
            )
            model = model.join(parent, check.column, "left")
            broken = F.col(check.column).isNotNull() & F.col(hit).isNull()
        else:
            broken = _broken(check)
        counted.append(F.count_if(broken).alias(f"_broken_{position}"))
    reports = [_report(check, F.col(f"_broken_{position}")) for position, check in enumerate(checks)]
    return model.agg(*counted).select(F.inline(F.array(*reports)))


def _repeated_keys(model: DataFrame, check: Check) -> DataFrame:
    """Keys that occur twice or more. All rows are grouped by a 64-bit key only; full values are compared where it repeats."""
    keyed = model.where(F.col(check.column).isNotNull()).select(check.column, unique_key(check.column).alias("_key"))
    again = keyed.groupBy("_key").count().where("count > 1").select("_key")
    repeated = keyed.join(again, "_key", "left_semi").groupBy(check.column).count().where("count > 1")
    return repeated.agg(F.count("*").alias("n")).select(F.inline(F.array(_report(check, F.col("n")))))


def run_checks(relations: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: model, column_name, test, violations."""
    checks = list(checks)
    reports = [_repeated_keys(relations[c.model], c) for c in checks if c.test == "unique"]
    rest = [c for c in checks if c.test != "unique"]
    for model in dict.fromkeys(c.model for c in rest):
        reports.append(_single_pass(relations[model], [c for c in rest if c.model == model], relations))
    return reduce(DataFrame.unionByName, reports)
