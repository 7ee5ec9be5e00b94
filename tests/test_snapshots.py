from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from trip_data import START, trip

from tripmart.config import Month, Rules
from tripmart.errors import CommitConflict
from tripmart.operators.ordinals import file_counts, file_offsets, with_global_ordinal
from tripmart.plans.pipeline import replace_months
from tripmart.plans.warehouse import DATE_MARTS, ROUTE_MARTS, Change, Warehouse
from tripmart.sources.schema import conform
from tripmart.sources.zones import read_zone_file

NOW = datetime(2026, 4, 6, 7, 30)
MART = "mart_daily_trip_metrics"


@pytest.fixture
def load(spark, raw_trips, zone_file, tmp_path):
    zones = read_zone_file(spark, zone_file)

    def run(warehouse, *months):
        frames = [conform(raw_trips(rows, (2026, month))) for month, rows in months]
        trips = frames[0]
        for frame in frames[1:]:
            trips = trips.unionByName(frame)
        return replace_months(trips, zones, warehouse, NOW)

    return Warehouse(spark, str(tmp_path / "wh"), Rules()), run


def in_month(month, **changes):
    start = START.replace(month=month)
    return trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start.replace(minute=start.minute + 20), **changes)


def content(frame):
    return sorted(map(repr, frame.collect()))


def everything(warehouse):
    return {name: content(warehouse.stored(name)) for name in (*DATE_MARTS, *ROUTE_MARTS, "time_rollup", "route_rollup")} | {"trips": content(warehouse.classified())}


def files(warehouse, name):
    return {str(path): path.stat().st_mtime_ns for path in Path(warehouse.path(name)).rglob("*.parquet")}


def test_a_run_that_fails_between_tables_changes_nothing(load, monkeypatch):
    warehouse, run = load
    run(warehouse, (1, [in_month(1), in_month(1, fare_amount=9.0)]))
    before, number = everything(warehouse), warehouse.snapshot.number

    def broken(self, months):
        raise RuntimeError("stop")

    monkeypatch.setattr(Change, "refresh_marts", broken)
    with pytest.raises(RuntimeError, match="stop"):
        run(warehouse, (1, [in_month(1)] * 3))
    assert everything(warehouse) == before and warehouse.snapshot.number == number
    monkeypatch.undo()
    run(warehouse, (1, [in_month(1)] * 3))
    assert warehouse.staging().count() == 3 == warehouse.stored(MART).first().trip_count


def test_a_reader_during_a_run_sees_one_state(load, monkeypatch):
    warehouse, run = load
    run(warehouse, (1, [in_month(1), in_month(1, fare_amount=9.0)]))
    before, seen = everything(warehouse), []
    relations = warehouse.relations()
    refresh = Change.refresh_marts

    def watched(self, months):
        refresh(self, months)
        seen.append((everything(warehouse), self.stored(MART).first().trip_count))

    monkeypatch.setattr(Change, "refresh_marts", watched)
    run(warehouse, (1, [in_month(1)] * 5))
    assert seen == [(before, 5)]
    # What was opened before goes on with its snapshot.
    assert content(relations[MART]) == before[MART] and relations["fct_trips"].count() == 2
    assert warehouse.relations()["fct_trips"].count() == 5


def test_a_late_file_rewrites_only_what_it_touches(load, spark, tmp_path):
    warehouse, run = load
    months = [(month, [in_month(month, fare_amount=float(n)) for n in range(3)]) for month in (1, 2, 3)]
    run(warehouse, *months)
    before = {name: files(warehouse, name) for name in (MART, "trips", "time_rollup")}
    number = warehouse.snapshot.number
    late = (3, [*months[2][1], in_month(3, fare_amount=30.0), in_month(2, fare_amount=31.0)])  # one trip began in February
    run(warehouse, late)
    for name, old in before.items():
        now = files(warehouse, name)
        assert {path: now.get(path) for path in old} == old
        added = [path for path in now if path not in old]
        assert added and all(("period=202602" in path or "period=202603" in path) if name == MART else "source_month=3" in path for path in added)
    parts, old = warehouse.snapshot.parts(MART), warehouse.at(number).snapshot.parts(MART)
    assert [part for part in sorted(parts) if parts[part] != old[part]] == ["202602", "202603"]
    # Folders of other commits are pruned by name.
    plan = warehouse.stored(MART)._jdf.queryExecution().executedPlan().toString()
    assert "commit" in plan.split("PartitionFilters: [")[1].split("]")[0]
    whole = Warehouse(spark, str(tmp_path / "whole"), Rules())
    run(whole, *months[:2], late)
    assert everything(warehouse) == everything(whole)


def test_old_snapshots_stay_readable_and_then_go(load):
    warehouse, run = load
    for fares in (1.0, 2.0, 3.0):
        run(warehouse, (1, [in_month(1, fare_amount=fares)]))
    assert warehouse.log.numbers() == [2, 3]
    assert [warehouse.at(number).staging().first().fare_amount for number in (2, 3)] == [2.0, 3.0]
    assert len(list(Path(warehouse.path("trips")).glob("commit=*"))) == 2


def test_two_runs_at_once_do_not_mix(load, spark):
    warehouse, run = load
    run(warehouse, (1, [in_month(1)]))
    late = warehouse.change()
    late.replace_zones(warehouse.zones().where("location_id < 2"))
    run(warehouse, (1, [in_month(1)] * 2))
    before = everything(warehouse), content(warehouse.zones())
    with pytest.raises(CommitConflict):
        late.commit()
    assert (everything(warehouse), content(warehouse.zones())) == before


@pytest.mark.parametrize("files_per_range", [1, 3, 100])
def test_ordinals_run_through_all_files(spark, tmp_path, files_per_range):
    sizes = [3, 1, 7, 2, 5, 1, 1, 4, 6, 2]
    for number, size in enumerate(sizes):
        spark.range(size).coalesce(1).write.parquet(str(tmp_path / f"files/part={number}"))
    place = [F.col("_metadata.file_path").alias("source_file"), (F.col("_metadata.row_index") + 1).alias("source_row_number")]
    rows = spark.read.parquet(str(tmp_path / "files")).select("part", *place)
    for known in (None, len(sizes)):
        numbered = with_global_ordinal(rows, file_offsets(file_counts(rows), known, files_per_range), "ordinal")
        found = sorted((r.part, r.source_row_number, r.ordinal) for r in numbered.collect())
        assert [ordinal for _, _, ordinal in found] == list(range(1, sum(sizes) + 1))
        assert [part for part, _, _ in found] == [part for part, size in enumerate(sizes) for _ in range(size)]


def test_ordinals_of_no_files(spark):
    rows = spark.createDataFrame([], "source_file string, source_row_number long")
    assert with_global_ordinal(rows, file_offsets(file_counts(rows)), "ordinal").collect() == []


def final_plan(frame) -> str:
    """The plan as it was run, with the changes made at run time."""
    ran = frame._jdf.queryExecution().executedPlan()
    ran.executeCollect()
    return ran.toString().split("Initial Plan")[0]


def numbered_files(spark, folder, known):
    spark.range(300_000).repartition(10).write.parquet(folder)
    rows = spark.read.parquet(folder).select(
        "id", F.col("_metadata.file_path").alias("source_file"), (F.col("_metadata.row_index") + 1).alias("source_row_number")
    )
    return with_global_ordinal(rows, file_offsets(file_counts(rows), known, 10 if known else 3), "ordinal").agg(F.sum("ordinal").alias("total"))


def test_rows_are_never_broadcast_to_their_offsets(spark, tmp_path):
    numbered = numbered_files(spark, str(tmp_path / "files"), None)
    text = final_plan(numbered)
    assert "BroadcastHashJoin [source_file" in text and "Inner, BuildLeft" not in text
    assert numbered.first().total == 300_000 * 300_001 // 2


def test_rows_are_not_shuffled_for_their_offsets(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        for known in (None, 10):
            numbered = numbered_files(spark, str(tmp_path / f"files-{known}"), known)
            assert "SortMergeJoin" not in final_plan(numbered)
            assert numbered.first().total == 300_000 * 300_001 // 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_offsets_of_very_many_files_are_joined_by_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tripmart.operators.ordinals.BROADCAST_FILES", 5)
    numbered = numbered_files(spark, str(tmp_path / "files"), None)
    text = final_plan(numbered)
    assert "SortMergeJoin" in text and "Inner, BuildLeft" not in text
    assert numbered.first().total == 300_000 * 300_001 // 2
