"""Sorted pages and argument checks of the served queries.

A page is asked for by offset, or by a token that holds the place where it begins. A token names the order, the sort
key and ties of the last row served, and how many rows equal to it were served. The next page then starts with a filter on the key, which
reaches the scan, and no earlier row is sorted. An index of page starts leads to pages far down a list without the pages before them.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.errors import EmptyResult, InvalidRequest
from tripmart.operators.ordinals import file_counts, file_offsets, with_global_ordinal
from tripmart.session import written

# Page size bounds.
DEFAULT_LIMIT = 100
MAX_LIMIT = 500


@dataclass(frozen=True)
class PageRequest:
    """Which part of a list is wanted, and in what order."""

    sort_by: str
    sort_order: str = "asc"
    limit: int = DEFAULT_LIMIT
    offset: int = 0
    max_limit: int = MAX_LIMIT
    after: str = ""

    def __post_init__(self) -> None:
        if not 1 <= self.limit <= self.max_limit:
            raise InvalidRequest(f"limit must lie in 1..{self.max_limit}, got {self.limit}")
        if self.offset < 0:
            raise InvalidRequest(f"offset must not be negative, got {self.offset}")
        if self.after and self.offset:
            raise InvalidRequest("a page begins after a token or at an offset, not both")
        if self.sort_order.lower() not in ("asc", "desc"):
            raise InvalidRequest(f"unknown sort order {self.sort_order!r}")


@dataclass(frozen=True)
class Order:
    """A sort key, its ties, and the direction of the key. Ties ascend, NULLs come last everywhere."""

    keys: tuple[str, ...]
    descending: bool

    def columns(self) -> list[Column]:
        key = F.col(self.keys[0])
        first = key.desc_nulls_last() if self.descending else key.asc_nulls_last()
        return [first, *[F.col(tie).asc_nulls_last() for tie in self.keys[1:]]]

    def texts(self) -> list[Column]:
        """The key and ties as text that casts back to the same values."""
        return [F.col(key).cast("string").alias(f"_text_{k}") for k, key in enumerate(self.keys)]

    def from_place(self, rows: DataFrame, place: Place) -> DataFrame:
        """Rows at or after a place. The bound on the key alone is stated by itself, so that it reaches the scan."""
        values = [None if text is None else F.lit(text).cast(rows.schema[key].dataType) for key, text in zip(self.keys, place.texts)]
        later = []
        for k, (key, value) in enumerate(zip(self.keys, values)):
            if value is None:
                continue
            same = [_equal(F.col(key), value) for key, value in zip(self.keys[:k], values)]
            beyond = F.col(key) < value if self.descending and k == 0 else F.col(key) > value
            later.append(reduce(Column.__and__, [*same, F.col(key).isNull() | beyond]))
        at = reduce(Column.__and__, [_equal(F.col(key), value) for key, value in zip(self.keys, values)])
        first = F.col(self.keys[0])
        if values[0] is None:
            rows = rows.where(first.isNull())
        else:
            rows = rows.where(first.isNull() | (first <= values[0] if self.descending else first >= values[0]))
        return rows.where(reduce(Column.__or__, [*later, at]))


def _equal(column: Column, value: Column | None) -> Column:
    return column.isNull() if value is None else column.isNotNull() & (column == value)


@dataclass(frozen=True)
class Place:
    """Where a page begins: after `skip` rows whose key and ties have these texts."""

    texts: tuple[str | None, ...]
    skip: int

    def token(self, order: Order) -> str:
        content = json.dumps([order.keys, order.descending, self.texts, self.skip], separators=(",", ":"))
        return base64.urlsafe_b64encode(content.encode()).decode()

    @staticmethod
    def of(token: str, order: Order) -> Place:
        """The place a token holds; a token that is damaged or belongs to another order is an error."""
        try:
            keys, descending, texts, skip = json.loads(base64.b64decode(token.encode(), altchars=b"-_", validate=True))
            right = isinstance(texts, list) and len(texts) == len(order.keys) and all(x is None or isinstance(x, str) for x in texts)
            right = right and type(skip) is int and skip >= 0
        except (ValueError, TypeError) as error:
            raise InvalidRequest("not a page token") from error
        if not right:
            raise InvalidRequest("not a page token")
        if (keys, descending) != (list(order.keys), order.descending):
            raise InvalidRequest("the token belongs to a list in another order")
        return Place(tuple(texts), skip)


@dataclass(frozen=True)
class Page:
    """A lazy page of rows; the total over all pages is counted when asked for."""

    items: DataFrame
    counted: DataFrame
    what: str
    rows: DataFrame
    order: Order
    request: PageRequest

    @cached_property
    def total(self) -> int:
        total = self.counted.count()
        if total == 0:
            raise EmptyResult(f"no {self.what} for the given filters")
        return total

    @cached_property
    def next_token(self) -> str | None:
        """Token of the page after this one, from this page's rows; None where the page is not full. After a full last page comes an empty one."""
        served = [tuple(row) for row in self.items.select(*self.order.texts()).collect()]
        if len(served) < self.request.limit:
            return None
        last = served[-1]
        equal = served.count(last)
        if equal == len(served):
            equal += self._equal_before(last)
        return Place(last, equal).token(self.order)

    def _equal_before(self, last: tuple) -> int:
        """Rows before this page that equal its last row, where all rows of the page do."""
        if self.request.after:
            place = Place.of(self.request.after, self.order)
            return place.skip if place.texts == last else 0
        if not self.request.offset:
            return 0
        ahead = self.rows.orderBy(*self.order.columns()).limit(self.request.offset)
        return ahead.select(*self.order.texts()).where(reduce(Column.__and__, [F.col(f"_text_{k}").eqNullSafe(F.lit(text)) for k, text in enumerate(last)])).count()


def page_of(rows: DataFrame, request: PageRequest, sortable: Mapping[str, str], ties: tuple[str, ...], counted: DataFrame, what: str) -> Page:
    """Order by the chosen key, then by ties, NULLs last; keep the rows asked for."""
    if request.sort_by not in sortable:
        raise InvalidRequest(f"cannot sort by {request.sort_by!r}; choose from {', '.join(sortable)}")
    key = sortable[request.sort_by]
    order = Order((key, *[tie for tie in ties if tie != key]), request.sort_order.lower() == "desc")
    begin, skip = rows, request.offset
    if request.after:
        place = Place.of(request.after, order)
        begin, skip = order.from_place(rows, place), place.skip
    return Page(begin.orderBy(*order.columns()).offset(skip).limit(request.limit), counted, what, rows, order, request)


@dataclass(frozen=True)
class PageIndex:
    """Where each page of a list begins: a stored table with one row for each page."""

    starts: DataFrame
    order: Order
    request: PageRequest

    def request_for(self, page: int) -> PageRequest:
        """The request for a page by number, from 1; it reads one row of the index and no row of earlier pages is sorted."""
        if page < 1:
            raise InvalidRequest(f"pages start at 1, got {page}")
        found = self.starts.where(F.col("page") == page).select(*self.order.texts(), "skip").take(1)
        if not found:
            raise EmptyResult(f"the list has no page {page}")
        *texts, skip = found[0]
        return replace(self.request, offset=0, after=Place(tuple(texts), skip).token(self.order))


def index_pages(page: Page) -> PageIndex:
    """Index the whole list that `page` is part of, for pages of its size.

    Only keys and ties are sorted, over the cluster. They are written in order and numbered by their place in the files, so no task sees
    all rows, and each page's first row stays. `skip` counts the rows equal to it that earlier pages hold.
    """
    order = page.order
    ordered = written(page.rows.select(*order.keys).orderBy(*order.columns()), "page-keys")
    # Part files are named in the order of their ranges.
    placed = ordered.select(*order.keys, F.col("_metadata.file_path").alias("_part_file"), (F.col("_metadata.row_index") + 1).alias("_part_row"))
    numbered = with_global_ordinal(placed, file_offsets(file_counts(placed, "_part_file")), "_ordinal", "_part_file", "_part_row")
    starts = numbered.where((F.col("_ordinal") - 1) % page.request.limit == 0)
    firsts = numbered.groupBy(*[F.col(key).alias(f"_key_{k}") for k, key in enumerate(order.keys)]).agg(F.min("_ordinal").alias("_first"))
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_key_{k}")) for k, key in enumerate(order.keys)])
    number = F.floor((F.col("_ordinal") - 1) / page.request.limit).cast("bigint") + 1
    found = starts.join(firsts, same).select(number.alias("page"), *order.keys, (F.col("_ordinal") - F.col("_first")).alias("skip"))
    return PageIndex(written(found.sort("page"), "page-starts"), order, page.request)


def in_dates(frame: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Rows whose pickup date lies in an inclusive, possibly open range."""
    if start is not None and end is not None and start > end:
        raise InvalidRequest("start date must not be after end date")
    if start is not None:
        frame = frame.where(F.col("pickup_date") >= F.lit(start))
    if end is not None:
        frame = frame.where(F.col("pickup_date") <= F.lit(end))
    return frame


def at_zone(frame: DataFrame, zone_id: int | None) -> DataFrame:
    """Rows that start or end in the zone."""
    if zone_id is None:
        return frame
    if zone_id < 1:
        raise InvalidRequest(f"zone ids start at 1, got {zone_id}")
    return frame.where((F.col("pickup_zone_id") == zone_id) | (F.col("dropoff_zone_id") == zone_id))
