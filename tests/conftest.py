from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from trip_data import RAW_SCHEMA, ZONE_CSV  # noqa: E402
from tripmart.session import local_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def raw_trips(spark):
    """Raw trips with lineage, from dicts of source columns."""
    from pyspark.sql import functions as F

    def build(rows, month=(2026, 1)):
        names = [part.strip().split(" ")[0] for part in RAW_SCHEMA.split(",")]
        values = [(*[row[name] for name in names], number) for number, row in enumerate(rows, start=1)]
        frame = spark.createDataFrame(values, RAW_SCHEMA + ", source_row_number bigint")
        return frame.withColumns(
            {
                "service": F.lit("yellow"),
                "source_year": F.lit(month[0]),
                "source_month": F.lit(month[1]),
                "source_file": F.lit("test"),
            }
        )

    return build


@pytest.fixture
def zone_file(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(ZONE_CSV, encoding="utf-8-sig")
    return str(path)


@pytest.fixture
def write_raw(spark):
    """Write raw rows as one Parquet file in a folder."""

    def write(rows, folder, schema=RAW_SCHEMA, mode="overwrite"):
        names = [part.strip().split(" ")[0] for part in schema.split(",")]
        frame = spark.createDataFrame([tuple(row[name] for name in names) for row in rows], schema)
        frame.coalesce(1).write.mode(mode).parquet(str(folder))
        return str(folder)

    return write
