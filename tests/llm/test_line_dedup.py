from __future__ import annotations

import duckdb

from tripmart.llm.line_dedup import LineDedup, drop_boilerplate
from tripmart.llm.oracle import LINE_DEDUP


def test_drops_lines_by_share_of_the_site(docs_of):
    rows = [(k, f"Menu\nown line {k}\n\nMenu\nshared {k // 2}\n", None, "a") for k in range(20)]
    rows += [(100 + k, f"Menu\nother {k}", None, "b") for k in range(2)] + [(200, "Menu\nx", None, None), (201, None, None, "a")]
    found = {r.doc_id: (r.text, r.lines_dropped) for r in drop_boilerplate(docs_of(rows), LineDedup()).collect()}
    assert found[3] == ("own line 3\n\nshared 1\n", 2)
    assert found[100] == ("Menu\nother 0", 0) and found[200] == ("Menu\nx", 0) and found[201] == (None, 0)


def test_ratio_is_exceeded_not_met(docs_of):
    rows = [(k, "often\nrest" + str(k) if k < 7 else f"rest{k}", None, "a") for k in range(100)]
    assert sum(r.lines_dropped for r in drop_boilerplate(docs_of(rows), LineDedup()).collect()) == 0
    assert sum(r.lines_dropped for r in drop_boilerplate(docs_of(rows[:99]), LineDedup()).collect()) == 7


def test_repeated_rows_count_alike_in_code_and_sql(docs_of):
    rows = [(k // 3, "often\nsame" if k < 6 else f"rest{k}", None, "a") for k in range(60)] + [(None, "often\nx", None, None)]
    docs = docs_of(rows)
    connection = duckdb.connect()
    connection.register("documents", docs.toArrow())
    theirs = connection.execute(LINE_DEDUP).fetchall()
    found = drop_boilerplate(docs).select("doc_id", "source", "text", "lines_dropped").collect()
    assert sorted(map(tuple, found), key=str) == sorted(theirs, key=str) and sum(r.lines_dropped for r in found) == 12


def test_odd_rows_columns_and_no_python(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    frame = drop_boilerplate(docs, LineDedup())
    assert frame.columns == [*docs.columns, "lines_dropped"]
    assert sorted(str((r.doc_id, r.text)) for r in frame.collect()) == sorted(str(row) for row in odd_rows)
    assert drop_boilerplate(frame, LineDedup()).columns == frame.columns
    assert "Python" not in frame._jdf.queryExecution().toString() and "Arrow" not in frame._jdf.queryExecution().toString()
    assert drop_boilerplate(docs_of([])).collect() == []


def test_all_lines_may_go(docs_of):
    rows = [(k, "Only this", None, "a") for k in range(5)]
    assert {(r.text, r.lines_dropped) for r in drop_boilerplate(docs_of(rows)).collect()} == {("", 1)}
