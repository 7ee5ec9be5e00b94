from __future__ import annotations

from datetime import date, datetime

import pytest

from tripmart.errors import EmptyResult, InvalidRequest, MissingRelation, UnknownZone
from tripmart.operators.paging import PageRequest
from tripmart.plans import models, rollups, serving

INGESTED = datetime(2026, 4, 6, 7, 30)
FACT_SCHEMA = (
    "trip_id string, service string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "pickup_date date, pickup_hour int, pickup_zone_id int, dropoff_zone_id int, passenger_count double, "
    "trip_distance double, fare_amount double, tip_amount double, tolls_amount double, total_amount double, "
    "payment_type int, rate_code_id int, duration_minutes double, average_speed_mph double, "
    "revenue_per_mile double, is_airport_trip boolean, quality_status string, quality_reasons string, "
    "source_file string, ingested_at timestamp_ntz"
)


def fact_row(name, start, end, ends, amounts, codes, measures, airport, status, reasons=""):
    passengers, miles, fare, tip, total = amounts
    return (
        name, "yellow", start, end, start.date(), start.hour, *ends, passengers, miles, fare, tip, 0.0, total,
        *codes, *measures, total / miles, airport, status, reasons, "f", INGESTED,
    )


@pytest.fixture(scope="module")
def relations(spark):
    at = lambda d, h, m=0: datetime(2026, 3, d, h, m)
    still = "zero_duration_positive_distance"
    trips = [
        fact_row("early", at(3, 6, 10), at(3, 6, 40), (7, 9), (2.0, 6.0, 20.0, 2.0, 24.0), (2, 1), (30.0, 12.0), False, "valid"),
        fact_row("night", at(3, 22), at(3, 22, 45), (9, 138), (1.0, 18.0, 55.0, 10.0, 72.0), (1, 2), (45.0, 24.0), True, "valid"),
        fact_row("still", at(4, 6, 5), at(4, 6, 5), (7, 7), (3.0, 1.5, 8.0, 0.0, 9.0), (3, 1), (0.0, None), False, "warning", still),
        fact_row("noon", at(5, 12), at(5, 13), (138, 7), (4.0, 30.0, 80.0, 12.0, 99.0), (1, 2), (60.0, 30.0), True, "warning", "duplicate_record"),
    ]
    fact = spark.createDataFrame(trips, FACT_SCHEMA)
    zones = [(7, "West", "Mill", "Streets", False), (9, "West", "Quay", "Streets", False), (138, "East", "Field", "Airports", True), (50, "East", "Moor", "Streets", False)]
    by_time, by_route = rollups.time_rollup(fact), rollups.route_rollup(fact)
    from tripmart.config import Rules

    return {
        "fct_trips": fact,
        "dim_zone": spark.createDataFrame(
            zones, "zone_id int, borough string, zone_name string, service_zone string, is_airport_zone boolean"
        ),
        "mart_daily_trip_metrics": rollups.mart_daily(by_time),
        "mart_hourly_demand": rollups.mart_hourly(by_time),
        "mart_revenue_metrics": rollups.mart_revenue(by_time),
        "mart_zone_demand": rollups.mart_zone(by_route),
        "mart_route_metrics": rollups.mart_route(by_route),
        "mart_anomalous_trips": models.mart_anomalous_trips(fact, Rules()),
        "dim_payment_type": models.dim_payment_type(spark),
    }


FIRST, LAST = date(2026, 3, 3), date(2026, 3, 5)


def test_overview_with_date_and_zone(relations):
    row = serving.require_trips(serving.overview(relations, FIRST, FIRST, 9))
    assert row == {
        "total_trips": 2,
        "total_revenue": 24.0 + 72.0,
        "average_fare": (20.0 + 55.0) / 2,
        "average_duration_minutes": (30.0 + 45.0) / 2,
        "total_distance": 6.0 + 18.0,
        "airport_trip_count": 1,
        "warning_trip_count": 0,
    }
    assert serving.require_trips(serving.overview(relations))["total_trips"] == 4


def test_empty_overview_is_an_error_but_empty_zone_summary_is_not(relations):
    later = date(2031, 1, 1)
    with pytest.raises(EmptyResult):
        serving.require_trips(serving.overview(relations, later))
    row = serving.zone_summary(relations, 7, later).first()
    assert (row.related_trip_count, row.total_revenue, row.average_trip_distance) == (0, 0.0, None)


def test_daily_paging_and_total(relations):
    page = serving.daily_metrics(relations, page=PageRequest("pickup_date", limit=1, offset=1))
    assert [r.pickup_date for r in page.items.collect()] == [date(2026, 3, 4)] and page.total == 3
    best = serving.daily_metrics(relations, page=PageRequest("total_revenue", "desc")).items.first()
    assert (best.trip_count, best.passenger_count, best.total_revenue) == (1, 4.0, 99.0)
    assert (best.average_duration_minutes, best.average_speed_mph, best.airport_trip_count) == (60.0, 30.0, 1)


def test_hourly_and_revenue_order(relations):
    hours = serving.hourly_demand(relations, page=PageRequest("pickup_hour", "desc")).items.collect()
    assert [(r.pickup_date.day, r.pickup_hour) for r in hours] == [(3, 22), (5, 12), (3, 6), (4, 6)]
    revenue = serving.revenue_metrics(relations, page=PageRequest("payment_type")).items.collect()
    assert [(r.payment_type, r.total_revenue) for r in revenue] == [(1, 72.0), (1, 99.0), (2, 24.0), (3, 9.0)]


def test_zones_keep_unused_zones(relations):
    page = serving.zones(relations, PageRequest("pickup_trip_count", "desc", limit=2))
    assert [r.zone_id for r in page.items.collect()] == [7, 9] and page.total == 4
    unused = serving.zones(relations).items.where("zone_id = 50").first()
    assert (unused.pickup_trip_count, unused.total_revenue, unused.average_trip_distance) == (0, 0.0, None)


def test_top_dropoff_zones(relations):
    page = serving.top_dropoff_zones(relations)
    found = [(r.zone_id, r.dropoff_trip_count, r.total_revenue) for r in page.items.collect()]
    assert found == [(7, 2, 9.0 + 99.0), (9, 1, 24.0), (138, 1, 72.0), (50, 0, 0.0)] and page.total == 4


def test_zone_summary(relations):
    row = serving.zone_summary(relations, 7).first()
    assert (row.zone_name, row.is_airport_zone) == ("Mill", False)
    assert (row.pickup_trip_count, row.dropoff_trip_count, row.related_trip_count) == (2, 2, 3)


def test_trip_inside_a_zone_counts_once_as_related(spark, relations):
    inside = relations["fct_trips"].where("trip_id = 'still'")
    row = serving.zone_summary({**relations, "fct_trips": inside}, 7).first()
    assert (row.pickup_trip_count, row.dropoff_trip_count, row.related_trip_count) == (1, 1, 1)


def test_routes_and_anomalies_carry_names(relations):
    page = serving.top_routes(relations, 138)
    row = page.items.first()
    assert (row.pickup_zone_name, row.dropoff_zone_name, page.total) == ("Quay", "Field", 2)
    found = serving.anomalies(relations)
    assert {r.trip_id for r in found.items.collect()} == {"still", "noon"} and found.total == 2
    with pytest.raises(EmptyResult):
        serving.anomalies(relations, date(2027, 1, 1)).total


def test_total_counts_rows_whose_zone_has_no_name(relations):
    known = {**relations, "dim_zone": relations["dim_zone"].where("zone_id <> 138")}
    page = serving.top_routes(known)
    assert page.total == 4 and page.items.count() == 2


def test_null_sort_keys_come_last_in_both_directions(spark, relations):
    for order in ("asc", "desc"):
        rows = serving.anomalies(relations, page=PageRequest("average_speed_mph", order)).items.collect()
        assert [r.trip_id for r in rows] == ["noon", "still"]


def test_daily_csv(relations, tmp_path):
    serving.write_daily_csv(relations, str(tmp_path / "csv"))
    files = list((tmp_path / "csv").glob("*.csv"))
    lines = files[0].read_text().splitlines()
    assert len(files) == 1 and lines[0].startswith("pickup_date,trip_count,passenger_count")
    assert [line[:13] for line in lines[1:]] == ["2026-03-03,2,", "2026-03-04,1,", "2026-03-05,1,"]
    with pytest.raises(EmptyResult):
        serving.write_daily_csv(relations, str(tmp_path / "none"), date(2031, 1, 1))


def test_export_leaves_out_no_day(spark):
    days = spark.range(25_000).selectExpr("date_add(date'2009-01-01', cast(id as int)) as pickup_date", "id as trip_count")
    assert serving.daily_export({"mart_daily_trip_metrics": days}).count() == 25_000


def test_labels(relations):
    rows = relations["mart_revenue_metrics"].selectExpr("pickup_date", "payment_type % 2 as payment_type")
    labeled = serving.payment_label(relations["dim_payment_type"], rows)
    labels = {r.label for r in labeled.select(serving.revenue_label().alias("label")).collect()}
    assert labels == {f"2026-03-0{day} / {name}" for day, name in ((3, "Credit card"), (3, "Type 0"), (4, "Credit card"), (5, "Credit card"))}


def test_metadata_and_readiness(relations):
    row = serving.metadata(relations).first()
    assert (row.service, row.service_status) == ("yellow", "available")
    assert (row.start_date, row.end_date) == (FIRST, LAST)
    assert (row.fct_trips_rows, row.mart_hourly_demand_rows) == (4, 4)
    assert serving.freshness(relations).first()[0] == INGESTED
    assert serving.readiness(relations).first().analytics_ready
    quiet = {**relations, "mart_anomalous_trips": relations["mart_anomalous_trips"].limit(0)}
    assert serving.readiness(quiet).first().analytics_ready
    no_trips = {**relations, "fct_trips": relations["fct_trips"].limit(0)}
    for broken in (no_trips, {k: v for k, v in relations.items() if k != "mart_zone_demand"}):
        assert not serving.readiness(broken).first().analytics_ready
    empty = serving.metadata(no_trips).first()
    assert (empty.service_status, empty.start_date) == ("empty", None)


def test_dashboard_lists(relations):
    pages = serving.dashboard(relations, limit=2)
    assert [r.pickup_hour for r in pages["hourly"].items.collect()] == [6, 6, 12, 22]
    assert pages["zones"].items.count() == 2 and pages["routes"].total == 4


@pytest.mark.parametrize(
    "call",
    [
        lambda r: PageRequest("pickup_date", limit=501),
        lambda r: PageRequest("pickup_date", limit=0),
        lambda r: PageRequest("pickup_date", offset=-1),
        lambda r: PageRequest("pickup_date", "sideways"),
        lambda r: serving.daily_metrics(r, page=PageRequest("trip_id")),
        lambda r: serving.daily_metrics(r, LAST, FIRST),
        lambda r: serving.overview(r, zone_id=0),
    ],
)
def test_bad_arguments(relations, call):
    with pytest.raises(InvalidRequest):
        call(relations)


def test_unknown_zone_and_missing_relation(relations):
    with pytest.raises(UnknownZone):
        serving.zone_summary(relations, 77)
    with pytest.raises(MissingRelation):
        serving.daily_metrics({})
