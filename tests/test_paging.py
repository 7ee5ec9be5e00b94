"""Pages by token and by index give the rows that pages by offset give, and read nothing before them."""

from __future__ import annotations

import base64
import random
from dataclasses import replace

import pytest

from tripmart.errors import EmptyResult, InvalidRequest
from tripmart.operators.paging import PageRequest, index_pages, page_of

SORTABLE = {"amount": "amount", "day": "day", "id": "id"}
SCHEMA = "amount double, day date, name string, id long"


def listed(frame, request):
    return page_of(frame, request, SORTABLE, ("name", "id"), frame, "rows")


@pytest.fixture(scope="module")
def rows(spark):
    """Few amounts and names, nulls and NaN among them, and rows that are equal in all sort columns."""
    from datetime import date

    draw = random.Random(5)
    values = [
        (draw.choice([None, float("nan"), -0.5, 0.1, 1e-7, 1e300]), draw.choice([None, date(2026, 1, 3), date(2025, 12, 9)]), draw.choice([None, "", "a|b", "ä\"x"]), draw.choice([None, 1, 2, 3]))
        for _ in range(300)
    ]
    return spark.createDataFrame(values, SCHEMA).repartition(5)


def walk(frame, request):
    """Rows of all pages by token, and each page's request."""
    found, requests = [], []
    while True:
        page = listed(frame, request)
        requests.append(request)
        found.append([str(row) for row in page.items.select("amount", "name", "id").collect()])
        if page.next_token is None:
            return found, requests
        request = replace(request, offset=0, after=page.next_token)


@pytest.mark.parametrize("key, direction", [("amount", "asc"), ("amount", "desc"), ("day", "desc"), ("id", "asc")])
def test_pages_by_token_are_the_pages_by_offset(rows, key, direction):
    rows = rows.select("amount", "day", "name", "id").cache()
    found, _ = walk(rows, PageRequest(key, direction, limit=70))
    whole = listed(rows, PageRequest(key, direction, limit=500)).items.select(key, "name", "id").collect()
    by_token = []
    request = PageRequest(key, direction, limit=70)
    while request:
        page = listed(rows, request)
        by_token += page.items.select(key, "name", "id").collect()
        request = replace(request, after=page.next_token) if page.next_token else None
    assert [len(page) for page in found] == [70, 70, 70, 70, 20]
    assert [str(row) for row in by_token] == [str(row) for row in whole]


def test_a_page_within_many_equal_rows(spark):
    frame = spark.createDataFrame([(1.0, None, "same", 7)] * 9 + [(2.0, None, "x", 8)], SCHEMA)
    found, requests = walk(frame, PageRequest("amount", limit=2))
    assert [len(page) for page in found] == [2] * 5 + [0] and sum(page.count("Row(amount=2.0, name='x', id=8)") for page in found) == 1
    begun = listed(frame, PageRequest("amount", limit=2, offset=4))
    assert begun.next_token == requests[3].after
    assert listed(frame, requests[5]).items.collect() == []


def test_index_leads_to_every_page(rows):
    page = listed(rows, PageRequest("amount", "desc", limit=32))
    index = index_pages(page)
    assert index.starts.count() == 10
    for number in (1, 2, 6, 10):
        direct = listed(rows, index.request_for(number)).items.select("amount", "name", "id").collect()
        offset = listed(rows, PageRequest("amount", "desc", limit=32, offset=32 * (number - 1))).items.select("amount", "name", "id").collect()
        assert str(direct) == str(offset)
    with pytest.raises(EmptyResult):
        index.request_for(11)
    with pytest.raises(InvalidRequest):
        index.request_for(0)
    empty = index_pages(listed(rows.limit(0), PageRequest("amount")))
    assert empty.starts.count() == 0


def scanned_rows(frame):
    """Rows that came out of the scan of a frame that has run."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan()
    if leaves.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        leaves = leaves.executedPlan()
    leaves = leaves.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_page_far_down_reads_no_earlier_files(spark, tmp_path):
    """100,000 rows in ten files sorted by key: page 10,000 comes from the last file, and its key is in the scan's filter."""
    spark.range(100_000).selectExpr("cast(id as double) amount", "cast(null as date) day", "'n' name", "id").repartitionByRange(10, "amount").sortWithinPartitions(
        "amount"
    ).write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    index = index_pages(listed(frame, PageRequest("amount", limit=10)))
    items = listed(frame, index.request_for(10_000)).items
    assert [row.id for row in items.collect()] == list(range(99_990, 100_000))
    assert "GreaterThanOrEqual(amount,99990.0)" in items._jdf.queryExecution().toString()
    assert scanned_rows(items) <= 15_000 < 100_000 == scanned_rows(listed(frame, PageRequest("amount", limit=10, offset=99_990)).items)


def test_bad_tokens_are_refused(rows):
    good = listed(rows, PageRequest("amount", limit=10)).next_token
    damaged = [good[:-4], "?", "ä", base64.urlsafe_b64encode(b"[1]").decode(), base64.urlsafe_b64encode(b'[["amount","name","id"],false,["1",null],0]').decode()]
    for token in damaged:
        with pytest.raises(InvalidRequest):
            listed(rows, PageRequest("amount", limit=10, after=token))
    for request in (PageRequest("amount", "desc", after=good), PageRequest("day", after=good)):
        with pytest.raises(InvalidRequest):
            listed(rows, request)
    with pytest.raises(InvalidRequest):
        PageRequest("amount", offset=1, after=good)
