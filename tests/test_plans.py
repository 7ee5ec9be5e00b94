from __future__ import annotations

import re

import pytest
from trip_data import SF_DIR

from tripmart.catalog.queries import QUERIES
from tripmart.catalog.store import driver_relations, driver_warehouse
from tripmart.operators.classify import classify
from tripmart.operators.paging import PageRequest
from tripmart.operators.ranking import survey_months
from tripmart.plans import rollups, serving
from tripmart.plans.pipeline import month_buckets
from tripmart.sources.driver_tables import DRIVER_INGESTED_AT, DRIVER_RULES, driver_trips, driver_zone_lookup
from tripmart.sources.schema import conform
from tripmart.sources.zones import zone_ids


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def trip_shuffles(text: str) -> list[str]:
    keys = [re.sub(r"#\w+", "", part) for part in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", text)]
    return [part for part in keys if part != "zone_id"]


def test_classification_shuffles_trips_once(spark):
    trips, ids = conform(driver_trips(spark, SF_DIR)), zone_ids(driver_zone_lookup(spark, SF_DIR))
    text = plan(classify(trips, ids, DRIVER_RULES, DRIVER_INGESTED_AT))
    assert trip_shuffles(text) == ["_record_key"]
    assert len(re.findall(r"BroadcastHashJoin \[(?:pickup|dropoff)_zone_id", text)) == 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "EvalPython" not in text


def test_classification_of_many_months_shuffles_trips_once(spark):
    trips = conform(driver_trips(spark, SF_DIR, by_order_month=True))
    ids = zone_ids(driver_zone_lookup(spark, SF_DIR))
    buckets = month_buckets(survey_months(trips), 4)
    text = plan(classify(trips, ids, DRIVER_RULES, DRIVER_INGESTED_AT, buckets=buckets))
    assert trip_shuffles(text) == ["_place"]


def test_classification_also_works_without_broadcasts(spark):
    trips, ids = conform(driver_trips(spark, SF_DIR)), zone_ids(driver_zone_lookup(spark, SF_DIR))
    expected = sorted(map(repr, classify(trips, ids, DRIVER_RULES, DRIVER_INGESTED_AT).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = classify(trips, ids, DRIVER_RULES, DRIVER_INGESTED_AT)
        assert "BroadcastHashJoin" not in plan(frame)
        assert sorted(map(repr, frame.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rollup_reads_needed_columns_and_aggregates_before_the_shuffle(spark):
    fact = driver_relations(spark, SF_DIR)["fct_trips"]
    text = plan(rollups.time_rollup(fact))
    assert text.count("Exchange ") == 1 and text.count("HashAggregate") == 2
    read = re.search(r"FileScan parquet \[(.*?)\]", text).group(1)
    assert "pickup_datetime" in read
    assert "quality_reasons" not in read and "stable_record_hash" not in read


def test_pages_are_top_k_and_date_filters_reach_the_scan(spark):
    relations = driver_relations(spark, SF_DIR)
    text = plan(serving.daily_metrics(relations, page=PageRequest("pickup_date", limit=15, offset=5)).items)
    assert "TakeOrderedAndProject" in text
    from datetime import date

    text = plan(serving.anomalies(relations, date(1997, 1, 1), date(1997, 2, 1)).items)
    assert "GreaterThanOrEqual(pickup_date" in text and "LessThanOrEqual(pickup_date" in text


def test_month_filter_prunes_partitions(spark):
    text = plan(driver_warehouse(spark, SF_DIR).staging().where("source_month = 1"))
    assert re.search(r"PartitionFilters: \[.*outcome.*source_month", text)


@pytest.mark.parametrize("name", ["zone_summary", "overview_zone", "metadata", "zones", "top_routes", "anomalies"])
def test_served_queries_have_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "EvalPython" not in text


@pytest.mark.parametrize("name", ["metadata", "freshness", "readiness"])
def test_counts_and_freshness_read_no_trip_file(spark, name):
    files = QUERIES[name](spark, SF_DIR).inputFiles()
    assert files and not any("/trips/" in file for file in files)


@pytest.mark.parametrize("name", ["dq_relationships", "revenue_labeled", "dim_rate_code"])
def test_dimension_joins_do_not_shuffle_trips(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_hot_records_are_joined_by_broadcast_and_sliced(spark):
    trips, ids = conform(driver_trips(spark, SF_DIR)), zone_ids(driver_zone_lookup(spark, SF_DIR))
    text = plan(classify(trips, ids, DRIVER_RULES, DRIVER_INGESTED_AT, hot=(1, 2, 3)))
    for kind in ("LeftAnti", "LeftSemi"):
        assert re.search(rf"BroadcastHashJoin \[_record_key#\w+\], \[_record_key#\w+\], {kind}", text)
    assert "_slice" in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["classified_trips", "validated_trips", "duplicate_rank"])
def test_lines_and_orders_are_joined_once_before_trips_are_read_again(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "l_orderkey" not in text and "FileScan parquet" in text


@pytest.mark.parametrize("name", ["classified_trips", "validated_trips", "duplicate_rank"])
def test_trips_are_shuffled_once_by_day_without_their_record_key(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert trip_shuffles(text) == ["_place"]
    below = text[text.index("Exchange hashpartitioning(_place") :]
    assert "_record_key" not in below and "source_row_number" in below
