from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from trip_data import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import rows_of
from tripmart.catalog.oracle import ORACLE
from tripmart.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def sql_engine():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry_returns_rows(spark):
    assert entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sql_engine, name):
    frame = QUERIES[name](spark, SF_DIR)
    cursor = sql_engine.execute(ORACLE[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, cursor.fetchall())



def test_trip_queries_work_where_the_corpus_part_cannot_be_imported():
    """In a process of its own, in which a library that only the corpus part needs is missing."""
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = sys.modules['regex'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]
