from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

import duckdb
import pytest
from trip_data import START, ZONE_IDS, trip
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.config import MONTH_COLUMNS, Month, Rules
from tripmart.errors import InvalidRequest, SchemaError
from tripmart.functions.trip import exact_minutes, record_hash, record_text, trip_id
from tripmart.operators.classify import classify, with_measures
from tripmart.operators.ranking import hot_records, rank_copies, survey_days, survey_months
from tripmart.operators.summary import rule_counts, status_counts, validation_summary
from tripmart.sources.schema import CLASSIFIED_SCHEMA, conform

NOW = datetime(2026, 4, 6, 7, 30)


@pytest.fixture
def classified(spark, raw_trips):
    ids = spark.createDataFrame([(zone,) for zone in ZONE_IDS], "zone_id int")
    return lambda rows: classify(conform(raw_trips(rows)), ids, Rules(), NOW)


def rejected_trips():
    """(trip, reason) with values on the wrong side of every threshold, near it and far from it."""
    limits = Rules()
    ends = {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"}
    amounts = ("trip_distance", "fare_amount", "total_amount")
    for column in (*ends, *amounts):
        yield trip(**{column: None}), f"missing_{ends.get(column, column)}"
    for column in amounts:
        for value in (-0.01, -1e6):
            yield trip(**{column: value}), f"negative_{column}"
    for value in (-1, -40):
        yield trip(passenger_count=value), "negative_passenger_count"
    for column, end in (("PULocationID", "pickup"), ("DOLocationID", "dropoff")):
        for value in (None, 0, max(ZONE_IDS) + 1):
            yield trip(**{column: value}), f"invalid_{end}_zone"
    for seconds in (1, 7200):
        yield trip(tpep_dropoff_datetime=START - timedelta(seconds=seconds)), "pickup_after_dropoff"
    for minutes in (-1, limits.max_duration_minutes + 1, 9 * limits.max_duration_minutes):
        yield trip(tpep_dropoff_datetime=START + timedelta(minutes=minutes)), "duration_out_of_range"
    for speed in (limits.max_speed_mph + 1, 40 * limits.max_speed_mph):
        hour = {"tpep_dropoff_datetime": START + timedelta(hours=1)}
        yield trip(trip_distance=speed, **hour), "unreasonable_average_speed"


def accepted_trips():
    """Trips that just keep to every threshold."""
    limits = Rules()
    yield trip(passenger_count=0, fare_amount=0.0, total_amount=0.0, trip_distance=0.0)
    yield trip(tpep_dropoff_datetime=START + timedelta(minutes=limits.max_duration_minutes))
    yield trip(trip_distance=limits.max_speed_mph, tpep_dropoff_datetime=START + timedelta(hours=1))
    for zone in ZONE_IDS:
        yield trip(PULocationID=zone, DOLocationID=zone)


def test_rejection_rules_fire_beyond_their_thresholds(classified):
    cases = list(rejected_trips())
    rows = {r.source_row_number: r for r in classified([changed for changed, _ in cases]).collect()}
    for number, (_, reason) in enumerate(cases, start=1):
        assert rows[number].quality_status == "rejected"
        assert reason in rows[number].quality_reasons.split("|")


def test_rejection_rules_spare_their_thresholds(classified):
    assert {r.quality_status for r in classified(list(accepted_trips())).collect()} == {"valid"}


def test_copies_and_rejections_are_counted(classified):
    rows = classified([trip(), trip(), trip(), trip(tip_amount=0.0), trip(total_amount=-3.0)])
    assert {r.quality_status: r.row_count for r in status_counts(rows).collect()} == {
        "valid": 2,
        "warning": 2,
        "rejected": 1,
    }
    kept = rows.where("quality_status <> 'rejected'").collect()
    assert len({r.trip_id for r in kept}) == 4
    assert len({r.stable_record_hash for r in kept}) == 2
    assert sorted(r.trip_id[-5:] for r in kept) == ["-0001", "-0001", "-0002", "-0003"]
    fired = {"duplicate_record": 2, "negative_total_amount": 1}
    assert {r.rule: r.row_count for r in rule_counts(rows).collect()} == fired
    summary = validation_summary(rows).first()
    assert (summary.total_rows, summary.status_counts.warning, summary.validated_at) == (5, 2, "2026-04-06T07:30:00Z")
    assert summary.rule_counts == fired


def test_ingest_time_is_stored_and_printed_in_utc(spark, raw_trips):
    ids = spark.createDataFrame([(zone,) for zone in ZONE_IDS], "zone_id int")
    stamp = datetime(2026, 4, 6, 12, 30, tzinfo=timezone(timedelta(hours=5)))
    rows = classify(conform(raw_trips([trip()])), ids, Rules(), stamp)
    assert rows.first().ingested_at == NOW
    assert validation_summary(rows).first().validated_at == "2026-04-06T07:30:00Z"


def test_zero_duration_warns_and_reasons_keep_rule_order(classified):
    same_time = {"tpep_dropoff_datetime": START}
    rows = classified([trip(**same_time), trip(**same_time), trip(trip_distance=None, fare_amount=-1.0)])
    reasons = {r.source_row_number: r.quality_reasons for r in rows.collect()}
    assert reasons == {
        1: "zero_duration_positive_distance",
        2: "zero_duration_positive_distance|duplicate_record",
        3: "missing_trip_distance|negative_fare_amount",
    }


def test_status_counts_are_zero_filled(classified):
    counts = {r.quality_status: r.row_count for r in status_counts(classified([trip()])).collect()}
    assert counts == {"valid": 1, "warning": 0, "rejected": 0}


def test_missing_passengers_are_valid_and_columns_keep_contract(classified):
    rows = classified([trip(passenger_count=None)])
    assert rows.first().quality_status == "valid"
    assert rows.columns == CLASSIFIED_SCHEMA.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in CLASSIFIED_SCHEMA]


@pytest.mark.parametrize(
    ("pickup", "dropoff", "expected"),
    [(132, 57, True), (41, 138, True), (41, 57, False), (None, 88, None), (None, 132, True), (138, None, True)],
)
def test_airport_flag_is_three_valued(classified, pickup, dropoff, expected):
    assert classified([trip(PULocationID=pickup, DOLocationID=dropoff)]).first().is_airport_trip is expected


def test_duration_counts_second_boundaries(spark, raw_trips):
    rows = raw_trips(
        [
            trip(
                tpep_pickup_datetime=START.replace(microsecond=900_000),
                tpep_dropoff_datetime=START.replace(second=2, microsecond=100_000),
            ),
            trip(
                tpep_pickup_datetime=START.replace(microsecond=900_000),
                tpep_dropoff_datetime=START.replace(microsecond=100_000),
            ),
        ]
    )
    measured = with_measures(conform(rows)).withColumn("exact", exact_minutes("pickup_datetime", "dropoff_datetime"))
    found = {r.source_row_number: r for r in measured.collect()}
    assert found[1].duration_minutes * 60 == pytest.approx(2.0)
    assert found[1].exact * 60 == pytest.approx(1.2)
    assert found[2].duration_minutes == 0.0 and found[2].average_speed_mph is None
    assert found[2].exact * 60 == pytest.approx(-0.8)


def test_subsecond_reversal_is_rejected_with_both_reasons(classified):
    row = classified(
        [
            trip(
                tpep_pickup_datetime=START.replace(microsecond=900_000),
                tpep_dropoff_datetime=START.replace(microsecond=100_000),
            )
        ]
    ).first()
    assert row.quality_status == "rejected"
    assert row.quality_reasons == "pickup_after_dropoff|zero_duration_positive_distance"


def test_durations_ignore_session_time_zone(spark, raw_trips):
    spring = datetime(2026, 3, 8, 1, 30)
    rows = raw_trips(
        [trip(tpep_pickup_datetime=spring, tpep_dropoff_datetime=spring + timedelta(hours=2))]
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert with_measures(conform(rows)).first().duration_minutes == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_conform_fills_absent_columns_and_resolves_aliases(spark, raw_trips):
    frame = raw_trips([trip(Airport_fee=1.25)])
    renamed = frame.withColumnRenamed("Airport_fee", "airport_fee").withColumnRenamed("RatecodeID", "rate_code_id")
    row = conform(renamed.drop("VendorID", "extra")).first()
    assert row.airport_fee == 1.25 and row.rate_code_id == 5
    assert row.vendor_id is None and row.extra is None


def test_conform_casts_without_failing(spark, raw_trips):
    frame = raw_trips([trip()]).withColumns(
        {
            "PULocationID": F.lit(2.5),
            "DOLocationID": F.lit("1.5"),
            "payment_type": F.lit("cash"),
            "RatecodeID": F.lit(float("nan")),
            "trip_distance": F.lit("3.25"),
        }
    )
    row = conform(frame).first()
    assert (row.pickup_zone_id, row.dropoff_zone_id) == (2, 2)
    assert row.payment_type is None and row.rate_code_id is None and row.trip_distance == 3.25


def test_conform_names_missing_columns_in_order(raw_trips):
    frame = raw_trips([trip()]).drop("trip_distance").withColumnRenamed("PULocationID", "pulocationid")
    with pytest.raises(SchemaError, match="PULocationID, trip_distance"):
        conform(frame)


def test_trip_id_keeps_all_digits(spark):
    ranks = spark.createDataFrame([(1,), (9999,), (10000,), (123456,)], "n bigint")
    ids = [r.i for r in ranks.select(trip_id(F.lit("h"), F.col("n")).alias("i")).collect()]
    assert ids == ["h-0001", "h-9999", "h-10000", "h-123456"]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.floats(min_value=-1e15, max_value=1e15).filter(lambda x: x == 0 or abs(x) >= 1e-4),
            st.integers(0, 10**9).map(lambda n: n / 100),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_hash_text_of_doubles_matches_sql_engine(spark, values):
    values = [v if v is None or math.isfinite(v) else None for v in values]
    columns = [("x", "double"), ("y", "bigint")]
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, y bigint")
    texts = frame.withColumn("text", record_text(columns))
    ours = {r.y: r.h for r in texts.select("y", record_hash("text", columns).alias("h")).collect()}
    connection = duckdb.connect()
    for position, value in enumerate(values):
        theirs = connection.execute(
            "SELECT md5(concat_ws(chr(31), coalesce(cast(?::DOUBLE AS VARCHAR), '<NULL>'), ?))",
            [value, str(position)],
        ).fetchall()[0][0]
        assert ours[position] == theirs, value


def _skewed(raw_trips, copies=120):
    rows = [trip() for _ in range(copies)] + [trip(fare_amount=float(i % 40)) for i in range(160)]
    rows += [trip(store_and_fwd_flag=None), trip(store_and_fwd_flag="<NULL>")]
    return conform(raw_trips(rows))


def _ranks(frame):
    return sorted((r.stable_record_hash, r.source_row_number, r.duplicate_rank) for r in frame.collect())


def test_hot_records_are_found_and_ranked_exactly(raw_trips):
    trips = _skewed(raw_trips)
    surveys = survey_months(trips, hot_group_rows=50)
    assert [s.month for s in surveys] == [Month("yellow", 2026, 1)] and surveys[0].rows == 282
    hot = hot_records(surveys)
    assert len(hot) == 1
    plain = rank_copies(trips)
    window = Window.partitionBy(*MONTH_COLUMNS, "stable_record_hash").orderBy("source_row_number")
    assert _ranks(plain) == _ranks(plain.withColumn("duplicate_rank", F.row_number().over(window)))
    assert _ranks(rank_copies(trips, hot, slice_rows=7)) == _ranks(plain)
    assert _ranks(rank_copies(trips, buckets=F.lit(3))) == _ranks(plain)


def _of_days(raw_trips, month=(2026, 1)):
    """Ten days of seven trips, one of 90, and trips without pickup; every trip has a copy."""
    pickups = [START + timedelta(days=day, minutes=n) for day in range(10) for n in range(7)]
    pickups += [START + timedelta(days=30, minutes=n) for n in range(90)] + [None] * 3
    return conform(raw_trips([trip(tpep_pickup_datetime=pickup, tip_amount=n / 4) for n, pickup in enumerate(pickups)] * 2, month))


def test_a_pickup_day_lies_in_one_task_unless_it_is_very_large(raw_trips):
    trips = _of_days(raw_trips).unionByName(_of_days(raw_trips, (2026, 2)))
    surveys = survey_months(trips)
    days = survey_days(trips, surveys, rows_per_task=40)
    assert days.tasks == math.ceil(trips.count() / 40)
    assert days.parts == {"yellow/2026/1/2026-02-08": 5, "yellow/2026/2/2026-02-08": 5}
    plain = _ranks(rank_copies(trips))
    hot = hot_records(survey_months(trips, hot_group_rows=2))
    for buckets in (None, F.lit(6)):
        ranked = rank_copies(trips, buckets=buckets, days=days)
        assert _ranks(ranked) == plain and ranked.columns == rank_copies(trips).columns
        assert _ranks(rank_copies(trips, hot, buckets, slice_rows=1, days=days)) == plain
        placed = ranked.withColumn("task", F.spark_partition_id()).groupBy(*MONTH_COLUMNS, F.to_date("pickup_datetime").alias("day"))
        placed = placed.agg(F.count("*").alias("rows"), F.countDistinct("task").alias("tasks"))
        for row in placed.collect():
            assert 1 < row.tasks <= 5 if row.rows > 40 else row.tasks == 1, row


def test_few_trips_are_dealt_as_the_session_says(raw_trips):
    trips = _of_days(raw_trips)
    days = survey_days(trips, survey_months(trips))
    assert days.tasks is None and days.parts == {}


def test_no_task_holds_a_hot_group(raw_trips):
    trips = _skewed(raw_trips)
    hot = hot_records(survey_months(trips, hot_group_rows=50))
    sizes = (
        rank_copies(trips, hot, slice_rows=10)
        .withColumn("slice", F.floor(F.col("source_row_number") / 10))
        .groupBy("stable_record_hash", "slice")
        .count()
    )
    assert sizes.agg(F.max("count")).first()[0] <= 10


def test_null_and_its_mark_share_a_hash_and_are_numbered(raw_trips):
    ranked = rank_copies(conform(raw_trips([trip(store_and_fwd_flag=None), trip(store_and_fwd_flag="<NULL>")])))
    assert sorted(r.duplicate_rank for r in ranked.collect()) == [1, 2]


def test_copies_are_numbered_per_month(raw_trips):
    both = conform(raw_trips([trip()])).unionByName(conform(raw_trips([trip()], month=(2026, 2))))
    assert [r.duplicate_rank for r in rank_copies(both).collect()] == [1, 1]


@pytest.mark.parametrize("bad", [(2008, 1, "yellow"), (2101, 1, "yellow"), (2026, 13, "yellow"), (2026, 1, "green")])
def test_month_requests_are_checked(bad):
    with pytest.raises(InvalidRequest):
        Month.checked(*bad)
