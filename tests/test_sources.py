from __future__ import annotations

import hashlib
import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from trip_data import RAW_SCHEMA, ZONE_IDS, trip

from tripmart.config import Month
from tripmart.errors import InvalidRequest, ZoneLookupError
from tripmart.operators.profile import profile_files, write_profile
from tripmart.sources.files import append_inventory, file_inventory, parquet_footers, table_files
from tripmart.sources.trips import month_files, read_month, write_sample
from tripmart.sources.zones import read_zone_file, zone_ids, zone_table

JANUARY = Month("yellow", 2026, 1)


def test_read_month_conforms_files_with_different_types(spark, write_raw, tmp_path):
    write_raw([trip(), trip(fare_amount=2.0)], tmp_path / "m")
    doubles = RAW_SCHEMA.replace("passenger_count bigint", "passenger_count double").replace(
        "Airport_fee", "airport_fee"
    )
    write_raw([{**trip(passenger_count=2.0), "airport_fee": 1.5}], tmp_path / "m", doubles, mode="append")
    rows = read_month(spark, str(tmp_path / "m"), JANUARY).collect()
    assert sorted((r.passenger_count, r.airport_fee) for r in rows) == [(2.0, 1.5), (3.0, 0.0), (3.0, 0.0)]
    assert [r.source_row_number for r in sorted(rows, key=lambda r: (r.source_file, r.source_row_number))] == [1, 2, 3]
    assert len({r.source_file for r in rows}) == 2
    assert {(r.service, r.source_year, r.source_month) for r in rows} == {("yellow", 2026, 1)}


def test_sample_takes_the_first_rows_with_all_columns(spark, write_raw, tmp_path):
    folder = write_raw([trip(fare_amount=float(i)) for i in range(20)], tmp_path / "raw")
    source = next(Path(folder).glob("*.parquet"))
    assert write_sample(spark, str(source), str(tmp_path / "sample"), 5) == 5
    sample = spark.read.parquet(str(tmp_path / "sample"))
    assert sorted(r.fare_amount for r in sample.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert len(sample.columns) == 19
    assert write_sample(spark, str(source), str(tmp_path / "all"), 500) == 20
    with pytest.raises(InvalidRequest):
        write_sample(spark, str(source), str(tmp_path / "none"), 0)


def test_zone_table_and_ids(spark, zone_file):
    lookup = read_zone_file(spark, zone_file)
    assert {r.location_id for r in zone_table(lookup).collect()} == set(ZONE_IDS)
    assert {r.zone_id for r in zone_ids(lookup).collect()} == set(ZONE_IDS)


def test_zone_file_follows_csv_quoting(spark, tmp_path):
    path = tmp_path / "z.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n5,"A, B","The ""Old"" Pier, South","two\nlines"\n6,,"",x\n', encoding="utf-8-sig")
    rows = {r.location_id: tuple(r)[1:] for r in zone_table(read_zone_file(spark, str(path))).collect()}
    assert rows[5] == ("A, B", 'The "Old" Pier, South', "two\nlines") and set(rows) == {5, 6}


def test_tables_are_counted_from_metadata(spark, tmp_path):
    for name, rows, files in (("one", 30, 3), ("two", 0, 1)):
        spark.range(rows).repartition(files).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = {r.table_name: (r.file_count, r.row_count) for r in table_files(spark, str(tmp_path), ["one", "two"]).collect()}
    assert found == {"one": (3, 30), "two": (0, 0)}


def test_zone_ids_are_strict_while_loading_skips_bad_rows(spark, tmp_path):
    path = tmp_path / "z.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1,A,B,C\n1,A,B,C\n ,A,B,C\nx,A,B,C\n")
    lookup = read_zone_file(spark, str(path))
    assert [r.location_id for r in zone_table(lookup).collect()] == [1, 1]
    with pytest.raises(ZoneLookupError, match="not whole numbers"):
        zone_ids(lookup)
    assert [r.zone_id for r in zone_ids(lookup.where("LocationID IS NULL OR LocationID <> 'x'")).collect()] == [1]
    with pytest.raises(ZoneLookupError, match="no zone ids"):
        zone_ids(lookup.limit(0))
    bare = tmp_path / "bare.csv"
    bare.write_text("id,name\n1,A\n")
    with pytest.raises(ZoneLookupError, match="LocationID"):
        read_zone_file(spark, str(bare))


def test_profile_document(spark, tmp_path):
    """Twelve rows with gaps in a pattern; expectations are computed from the same rows."""
    start = datetime(2025, 7, 3, 9, 15)
    names = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "fare_amount", "total_amount", "PULocationID", "DOLocationID"]
    rows = []
    for n in range(12):
        full = [start + timedelta(hours=n), start + timedelta(hours=n, minutes=20 + n), n % 4, 0.5 + n, 3.0 * n, 3.25 * n + 1, 40 + n, 60 - n]
        rows.append(tuple(None if (n + k) % 5 == 0 and k < 6 else value for k, value in enumerate(full)))
    kinds = ["timestamp_ntz", "timestamp_ntz", "bigint", "double", "double", "double", "bigint", "bigint"]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds, strict=True))
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "p"))
    path = str(next((tmp_path / "p").glob("*.parquet")))
    profile = profile_files(spark, [path])
    columns = {name: [row[k] for row in rows if row[k] is not None] for k, name in enumerate(names)}
    assert profile["row_count"] == 12 and profile["row_groups"] == 1
    assert profile["file_size"] == Path(path).stat().st_size
    assert profile["null_counts"] == {name: 12 - len(values) for name, values in columns.items()}
    for label, name in (("pickup", names[0]), ("dropoff", names[1])):
        assert profile["datetime_ranges"][label] == {"min": min(columns[name]).isoformat(), "max": max(columns[name]).isoformat()}
    for name in ("trip_distance", "fare_amount", "total_amount"):
        values = columns[name]
        expected = {"min": min(values), "max": max(values), "avg": pytest.approx(sum(values) / len(values))}
        assert profile["numeric_stats"][name] == expected


def test_profile_leaves_out_absent_columns(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "p"))
    profile = profile_files(spark, [str(next((tmp_path / "p").glob("*.parquet")))])
    assert profile["null_counts"] == {} and profile["datetime_ranges"] == {} and profile["numeric_stats"] == {}


def test_inventory_matches_files_and_is_appended(spark, write_raw, tmp_path):
    folder = Path(write_raw([trip()], tmp_path / "raw"))
    file = next(folder.glob("*.parquet"))
    inventory = file_inventory(spark, str(folder), "*.parquet")
    row = inventory.first()
    assert row.sha256 == hashlib.sha256(file.read_bytes()).hexdigest()
    assert (row.file_size, row.row_count) == (file.stat().st_size, 1)
    append_inventory(inventory, str(tmp_path / "manifest"))
    append_inventory(inventory, str(tmp_path / "manifest"))
    assert spark.read.parquet(str(tmp_path / "manifest")).count() == 2
    footer = parquet_footers(spark, [str(file)]).first()
    assert (footer.row_count, footer.row_groups, len(footer.column_names)) == (1, 1, 19)


def test_profile_of_files_with_different_types(spark, write_raw, tmp_path):
    write_raw([trip(passenger_count=1)], tmp_path / "m")
    doubles = RAW_SCHEMA.replace("passenger_count bigint", "passenger_count double")
    write_raw([trip(passenger_count=None)], tmp_path / "m", doubles, mode="append")
    profile = profile_files(spark, month_files(spark, str(tmp_path / "m")))
    assert profile["row_count"] == 2 and profile["null_counts"]["passenger_count"] == 1
    write_profile(spark, profile, str(tmp_path / "profile"))
    stored = json.loads(spark.read.text(str(tmp_path / "profile")).first()[0])
    assert stored["numeric_stats"] == profile["numeric_stats"]
