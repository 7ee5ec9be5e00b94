from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from trip_data import START, trip
from pyspark.sql import functions as F

from tripmart.config import Month, Rules
from tripmart.errors import ZoneLookupError
from tripmart.operators.checks import Check, run_checks, standard_checks
from tripmart.plans.pipeline import PipelineConfig, replace_months, run_pipeline
from tripmart.plans.serving import daily_metrics
from tripmart.plans.warehouse import Warehouse
from tripmart.sources.schema import conform
from tripmart.sources.summaries import latest_summary, read_summaries
from tripmart.sources.trips import read_month
from tripmart.sources.zones import read_zone_file
from tripmart.streaming.arrivals import ingest_arrivals

NOW = datetime(2026, 4, 6, 7, 30)
JAN, FEB = Month("yellow", 2026, 1), Month("yellow", 2026, 2)
DEMO = [trip(), trip(), trip(), trip(tip_amount=9.0), trip(total_amount=-2.0), trip(trip_distance=None)]


def content(frame):
    names = [name for name in frame.columns if name != "source_file"]
    return sorted(map(repr, frame.select(*names).collect()))


def test_whole_run_on_a_few_rows(spark, write_raw, zone_file, tmp_path):
    raw = write_raw(DEMO, tmp_path / "raw")
    config = PipelineConfig({JAN: raw}, zone_file, str(tmp_path / "wh"), NOW)
    report = run_pipeline(spark, config)
    assert report["loaded_rows"] == 4 and report["zone_rows"] == 5 and report["analytics_ready"]
    assert report["failed_checks"] == [] and report["profiles"][JAN]["row_count"] == 6
    warehouse = Warehouse(spark, str(tmp_path / "wh"), Rules())
    day = daily_metrics(warehouse.relations()).items.collect()
    assert len(day) == 1 and day[0].trip_count == 4 and day[0].total_revenue == 4 * 39.0
    reasons = sorted(r.quality_reasons for r in warehouse.outcome("rejected").collect())
    assert reasons == ["missing_trip_distance", "negative_total_amount"]
    summary = latest_summary(spark, warehouse.path("summaries"))
    assert summary["status_counts"] == {"valid": 2, "warning": 2, "rejected": 2}
    assert summary["artifact_name"] == "validation_2026_01_yellow"
    (document,) = read_summaries(spark, warehouse.path("summaries")).collect()
    assert document.source_path == config.raw_paths[JAN]
    kept = {name: spark.read.parquet(document.outputs[name]).count() for name in ("validated", "rejected")}
    assert kept == {"validated": 4, "rejected": 2}


@pytest.fixture
def load(spark, raw_trips, zone_file, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), Rules())
    zones = read_zone_file(spark, zone_file)

    def run(*months, asked=()):
        frames = [conform(raw_trips(rows, (m.year, m.month))) for m, rows in months]
        trips = frames[0]
        for frame in frames[1:]:
            trips = trips.unionByName(frame)
        return replace_months(trips, zones, warehouse, NOW, asked)

    return warehouse, run


def test_rerun_changes_nothing_and_months_are_independent(load):
    warehouse, run = load
    assert run((JAN, DEMO), (FEB, [trip(), trip(total_amount=None)])).loaded_rows == 5
    before = content(warehouse.classified())
    marts = content(warehouse.stored("mart_daily_trip_metrics"))
    assert run((FEB, [trip(), trip(total_amount=None)])).loaded_rows == 1
    assert content(warehouse.classified()) == before
    assert content(warehouse.stored("mart_daily_trip_metrics")) == marts


def test_replacing_a_month_leaves_no_old_rows(load):
    warehouse, run = load
    run((JAN, DEMO), (FEB, [trip()]))
    run((JAN, [trip(fare_amount=-1.0)]))
    assert warehouse.staging().where("source_month = 1").count() == 0
    assert warehouse.outcome("rejected").where("source_month = 1").count() == 1
    assert warehouse.stored("mart_daily_trip_metrics").first().trip_count == 1
    run((JAN, [trip()]))
    assert warehouse.outcome("rejected").count() == 0
    assert warehouse.staging().count() == 2


def test_an_asked_for_month_without_rows_ends_up_empty(load):
    warehouse, run = load
    run((JAN, DEMO), (FEB, [trip()]))
    report = run((FEB, [trip(), trip()]), asked=[JAN])
    assert report.months == (JAN, FEB) and report.loaded_rows == 2
    assert warehouse.classified().where("source_month = 1").count() == 0
    assert warehouse.stored("time_rollup").where("source_month = 1").count() == 0


def test_more_months_than_one_job_replaces(load):
    warehouse, run = load
    months = [Month("yellow", 2020 + n // 12, 1 + n % 12) for n in range(35)]
    run(*[(month, [trip(fare_amount=float(n)), trip(fare_amount=-1.0)]) for n, month in enumerate(months)])
    counts = warehouse.classified().groupBy("quality_status").count().collect()
    assert {r.quality_status: r["count"] for r in counts} == {"valid": 35, "rejected": 35}
    assert warehouse.staging().select("source_year", "source_month").distinct().count() == 35


def test_many_months_are_one_run(load):
    warehouse, run = load
    months = [Month("yellow", 2010 + n // 12, 1 + n % 12) for n in range(70)]
    run(*[(month, [trip(fare_amount=float(n))]) for n, month in enumerate(months[:69])], asked=months)
    assert warehouse.staging().count() == 69
    run((months[69], [trip()]), asked=months[60:])
    assert sorted((r.source_year, r.source_month) for r in warehouse.staging().collect()) == [(m.year, m.month) for m in [*months[:60], months[69]]]


def test_a_bad_lookup_changes_no_stored_table(load, spark, tmp_path):
    warehouse, run = load
    run((JAN, DEMO))
    zones, rows = content(warehouse.zones()), content(warehouse.classified())
    path = tmp_path / "bad.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\nseven,A,B,C\n")
    with pytest.raises(ZoneLookupError):
        replace_months(warehouse.classified(), read_zone_file(spark, str(path)), warehouse, NOW)
    assert content(warehouse.zones()) == zones and content(warehouse.classified()) == rows


def test_a_failed_write_leaves_the_old_table(load):
    warehouse, run = load
    run((JAN, DEMO))
    before = content(warehouse.stored("mart_daily_trip_metrics"))
    broken = warehouse.stored("mart_daily_trip_metrics").withColumn("trip_count", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        warehouse.change().replace_table("mart_zone_demand", broken)
    assert content(warehouse.stored("mart_daily_trip_metrics")) == before
    run((JAN, [trip()]))
    assert warehouse.stored("mart_daily_trip_metrics").first().trip_count == 1


def test_every_row_lands_in_one_outcome_and_marts_add_up(load):
    warehouse, run = load
    run((JAN, [trip(fare_amount=float(n % 9 - 2), trip_distance=float(n % 4)) for n in range(60)]))
    kept, dropped = warehouse.staging().count(), warehouse.outcome("rejected").count()
    assert kept + dropped == 60 and kept and dropped
    relations = warehouse.relations()
    for name, counter in (
        ("mart_daily_trip_metrics", "trip_count"),
        ("mart_hourly_demand", "trip_count"),
        ("mart_revenue_metrics", "trip_count"),
        ("mart_route_metrics", "trip_count"),
        ("mart_zone_demand", "pickup_trip_count"),
    ):
        assert relations[name].agg(F.sum(counter)).first()[0] == kept


def test_marts_agree_with_direct_aggregates(load):
    warehouse, run = load
    run((JAN, [trip(fare_amount=float(n), passenger_count=None if n % 3 else n) for n in range(30)]))
    relations = warehouse.relations()
    direct = relations["fct_trips"].groupBy("pickup_date").agg(
        F.avg("duration_minutes"), F.avg("average_speed_mph"), F.sum("passenger_count"), F.sum("total_amount")
    ).first()
    mart = relations["mart_daily_trip_metrics"].first()
    assert direct[1:] == (
        pytest.approx(mart.average_duration_minutes),
        pytest.approx(mart.average_speed_mph),
        mart.passenger_count,
        pytest.approx(mart.total_revenue),
    )


def test_splitting_hot_records_changes_no_row(spark, raw_trips, zone_file, tmp_path):
    rows = [trip() for _ in range(40)] + [trip(fare_amount=float(n % 7)) for n in range(30)]
    trips = conform(raw_trips(rows)).unionByName(conform(raw_trips(rows[:45], (2026, 2))))
    stored = []
    for name, threshold in (("plain", 1_000_000), ("split", 20)):
        warehouse = Warehouse(spark, str(tmp_path / name), Rules())
        replace_months(trips, read_zone_file(spark, zone_file), warehouse, NOW, hot_group_rows=threshold)
        stored.append(content(warehouse.classified()))
    assert stored[0] == stored[1] and len(stored[0]) == 115


@pytest.mark.parametrize("months", [[JAN], [JAN, FEB]])
def test_a_stored_pickup_day_lies_in_one_file_so_that_rollups_shuffle_little(spark, load, months):
    warehouse, run = load
    rows = [trip(tpep_pickup_datetime=(start := START + timedelta(days=day, minutes=n)), tpep_dropoff_datetime=start + timedelta(minutes=9)) for day in range(12) for n in range(8)]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        run(*[(month, rows) for month in months])
    finally:
        spark.conf.set(setting, "true")
    stored = warehouse.staging().select("source_month", F.to_date("pickup_datetime").alias("day"), F.input_file_name().alias("file"))
    days = stored.groupBy("source_month", "day").agg(F.count("*").alias("rows"), F.countDistinct("file").alias("files")).collect()
    assert len(days) == 12 * len(months) and all((row.rows, row.files) == (8, 1) for row in days)
    assert stored.select("file").distinct().count() > len(months)


def test_checks_count_violations(spark, load):
    warehouse, run = load
    run((JAN, DEMO), (FEB, [trip()]))
    assert len(standard_checks(Rules())) == 40
    found = run_checks(warehouse.relations(), standard_checks(Rules()))
    broken = {(r.model, r.column_name, r.test): r.violations for r in found.where("violations > 0").collect()}
    # The same record in two months has one id; the uniqueness checks report it.
    assert broken == {(m, "trip_id", "unique"): 1 for m in ("yellow_trips", "stg_trips", "fct_trips")}
    child = spark.createDataFrame([(1, -1.0), (None, None), (9, 2.0), (9, 200.0)], "k int, x double")
    relations = {"child": child, "parent": spark.createDataFrame([(1,), (1,)], "id int")}
    checks = [
        Check("child", "k", "relationships", parent="parent", parent_column="id"),
        Check("child", "k", "unique"),
        Check("child", "k", "not_null"),
        Check("child", "x", "non_negative"),
        Check("child", "x", "valid_duration", limit=100.0),
        Check("child", "x", "reasonable_speed", limit=100.0),
    ]
    counts = {(r.column_name, r.test): r.violations for r in run_checks(relations, checks).collect()}
    assert counts == {
        ("k", "relationships"): 2,
        ("k", "unique"): 1,
        ("k", "not_null"): 1,
        ("x", "non_negative"): 2,
        ("x", "valid_duration"): 3,
        ("x", "reasonable_speed"): 2,
    }


def test_arrivals_reprocess_only_touched_months(spark, write_raw, zone_file, tmp_path):
    raw, state = tmp_path / "raw", str(tmp_path / "state")
    warehouse = Warehouse(spark, str(tmp_path / "wh"), Rules())
    clock = iter([NOW, NOW + timedelta(days=1), NOW + timedelta(days=2)])

    def run():
        query = ingest_arrivals(
            spark, str(raw), state, lambda: read_zone_file(spark, zone_file), warehouse, lambda: next(clock)
        )
        query.awaitTermination()

    write_raw(DEMO, raw / JAN.directory)
    write_raw([trip(fare_amount=7.0)], raw / FEB.directory)
    run()
    assert warehouse.staging().count() == 5
    late = [trip(), trip(tpep_pickup_datetime=START + timedelta(minutes=1))]
    write_raw(late, raw / JAN.directory, mode="append")
    run()
    staged = warehouse.staging()
    loaded = {r.source_month: r["count"] for r in staged.groupBy("source_month").count().collect()}
    assert loaded == {1: 6, 2: 1}
    stamps = {r.source_month: r.at for r in staged.groupBy("source_month").agg(F.max("ingested_at").alias("at")).collect()}
    assert stamps == {1: NOW + timedelta(days=1), 2: NOW}
    run()
    assert warehouse.staging().count() == 7
    batch = Warehouse(spark, str(tmp_path / "batch"), Rules())
    trips = read_month(spark, str(raw / JAN.directory), JAN).unionByName(
        read_month(spark, str(raw / FEB.directory), FEB)
    )
    replace_months(trips, read_zone_file(spark, zone_file), batch, NOW)
    assert content(batch.staging().drop("ingested_at")) == content(staged.drop("ingested_at"))


def test_uniqueness_is_exact_when_keys_collide(spark, monkeypatch):
    from tripmart.operators import checks

    names = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,), ("c",), ("b",)], "name string")
    check = Check("names", "name", "unique")
    assert run_checks({"names": names}, [check]).first().violations == 2
    for key in (lambda column: F.lit(1).cast("bigint"), lambda column: F.length(column).cast("bigint")):
        monkeypatch.setattr(checks, "unique_key", key)
        assert run_checks({"names": names}, [check]).first().violations == 2
