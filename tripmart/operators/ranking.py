"""Occurrence numbers of identical records, also when one record makes up much of the data."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.config import MONTH_COLUMNS, Month
from tripmart.functions.trip import NULL_MARK, record_hash, record_text
from tripmart.sources.schema import TRIP_COLUMNS

# A group of copies up to this size is ranked by one task; larger ones are split.
HOT_GROUP_ROWS = 1_000_000
SLICE_ROWS = 1_000_000
# Least number of candidates the frequency sketch keeps per month; see sketch_size.
SKETCH_ITEMS = 16_384
SKETCH_MERGERS = 256
# A longer list of hot keys is joined without a broadcast hint.
BROADCAST_KEYS = 1_000_000
# Rows that one task numbers and sorts; a pickup day with more of them is split.
ROWS_PER_TASK = 500_000
# Groups of rows are told apart by a short number, since it is shuffled with every row.
PLACES = 1 << 20
# Order of the columns in the shuffle: blocks get about a sixth smaller where columns of many values stand together.
MANY_VALUES = ("source_row_number", "pickup_datetime", "dropoff_datetime", "total_amount", "fare_amount", "tip_amount", "trip_distance")
SOME_VALUES = (
    "pickup_zone_id", "dropoff_zone_id", "payment_type", "rate_code_id", "passenger_count", "vendor_id", "tolls_amount", "store_and_fwd_flag",
)

# Identity of a record in its month. The key comes first: it is short to shuffle and sort, and
# the hash, which settles equality, is only computed where the rows have arrived.
RECORD = [*MONTH_COLUMNS, "_record_key", "stable_record_hash"]


@dataclass(frozen=True)
class MonthSurvey:
    """Row count of a month and the keys of records with very many copies in it."""

    month: Month
    rows: int
    hot_records: tuple[int, ...]


@dataclass(frozen=True)
class DayPlaces:
    """How trips are dealt by pickup day: over how many tasks, where not as the session says, and into how many parts each very large day."""

    tasks: int | None = None
    parts: dict[str, int] = field(default_factory=dict)


def record_key() -> Column:
    """64-bit key of a record in its month. Records with equal hash have equal keys."""
    values = [
        F.coalesce(F.col(c.name), F.lit(NULL_MARK)) if c.kind == "string" else F.col(c.name)
        for c in TRIP_COLUMNS
    ]
    return F.xxhash64(*MONTH_COLUMNS, *values)


def with_record_hash(trips: DataFrame) -> DataFrame:
    """Content hash over the 19 typed columns; file, row and month play no part in it."""
    columns = [(c.name, c.kind) for c in TRIP_COLUMNS]
    texts = trips.withColumn("_text", record_text(columns))
    return texts.withColumn("stable_record_hash", record_hash("_text", columns)).drop("_text")


def survey_months(trips: DataFrame, hot_group_rows: int = HOT_GROUP_ROWS) -> list[MonthSurvey]:
    """Rows per month, and every record with at least `hot_group_rows` copies in its month.

    Counting reads no trip columns. Only months with enough rows to hold a hot group are looked
    into any further.
    """
    counted = trips.groupBy(*MONTH_COLUMNS).agg(F.count("*").alias("rows")).collect()
    rows = {Month(*row[:3]): row.rows for row in counted}
    suspects = sorted(month for month, count in rows.items() if count >= hot_group_rows)
    most = max((rows[month] for month in suspects), default=0) // hot_group_rows
    hot = _hot_records(trips.where(in_months(suspects)), hot_group_rows, most) if suspects else {}
    return [MonthSurvey(month, rows[month], hot.get(month, ())) for month in sorted(rows)]


def in_months(months: Iterable[Month]) -> Column:
    listed = [F.struct(F.lit(m.service), F.lit(m.year), F.lit(m.month)) for m in months]
    return F.struct(*MONTH_COLUMNS).isin(listed)


def _pickup_day() -> Column:
    return F.col("pickup_datetime").cast("date")


def _day_of_month() -> Column:
    """Month and pickup day as one text."""
    return F.concat_ws("/", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in MONTH_COLUMNS], F.coalesce(_pickup_day().cast("string"), F.lit("")))


def survey_days(trips: DataFrame, surveys: Sequence[MonthSurvey], rows_per_task: int = ROWS_PER_TASK) -> DayPlaces:
    """How to deal trips by pickup day so that no task gets many more than `rows_per_task` of them.

    Only pickup times are read, and only of months that can hold a very large day; at most one day for each `rows_per_task` rows is collected.
    """
    tasks = math.ceil(sum(survey.rows for survey in surveys) / rows_per_task)
    large = [survey.month for survey in surveys if survey.rows > rows_per_task]
    parts = {}
    if large:
        days = trips.where(in_months(large)).groupBy(_day_of_month().alias("day")).agg(F.count("*").alias("rows"))
        parts = {row.day: math.ceil(row.rows / rows_per_task) for row in days.where(F.col("rows") > rows_per_task).collect()}
    return DayPlaces(tasks if tasks > trips.sparkSession.sparkContext.defaultParallelism else None, parts)


def sketch_size(most: int) -> int:
    """Candidates to keep so that all of up to `most` hot records stand out: a power of two, four times as many."""
    return min(max(SKETCH_ITEMS, 1 << (4 * most).bit_length()), 1_000_000)


def _hot_records(trips: DataFrame, hot_group_rows: int, most: int) -> dict[Month, tuple[int, ...]]:
    """Keys of very frequent records per month, from one scan.

    A month of n rows holds at most n / hot_group_rows = `most` hot records, and that many are reported, so
    none is left unsplit. A frequent-items sketch is built per task, merged in two steps and grows with `most` only.
    """
    accumulate = F.call_function("approx_top_k_accumulate", record_key(), F.lit(sketch_size(most)))
    merged = (
        trips.groupBy(*MONTH_COLUMNS, (F.spark_partition_id() % SKETCH_MERGERS).alias("merger"))
        .agg(accumulate.alias("sketch"))
        .groupBy(*MONTH_COLUMNS)
        .agg(F.call_function("approx_top_k_combine", "sketch").alias("sketch"))
    )
    top = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(min(max(most, 1), sketch_size(most))))
    hot = F.transform(F.filter(top, lambda t: t["count"] >= hot_group_rows), lambda t: t["item"])
    found = merged.select(*MONTH_COLUMNS, hot.alias("hot")).collect()
    return {Month(*row[:3]): tuple(sorted(row.hot)) for row in found}


def hot_records(surveys: Sequence[MonthSurvey]) -> tuple[int, ...]:
    return tuple(key for survey in surveys for key in survey.hot_records)


def rank_copies(
    trips: DataFrame,
    hot: Sequence[int] = (),
    buckets: Column | None = None,
    slice_rows: int = SLICE_ROWS,
    days: DayPlaces | None = None,
) -> DataFrame:
    """Add stable_record_hash and duplicate_rank: 1, 2, ... per month and hash, in row order.

    `hot` lists record keys whose copies must not meet in one task; they are ranked slice by
    slice. `buckets` says into how many groups a row's month is split by the shuffle, so that a
    write of many months opens few files per task; without it every record is placed on its own.
    With `days` rows are placed by pickup day, which equal records share, so that a task holds whole days.
    """
    keyed = trips.withColumn("_record_key", record_key())
    if not hot:
        return _rank_together(keyed, buckets, days)
    # At most rows / hot_group_rows keys per month. A join, because a filter on a hash of all columns makes
    # the optimizer derive a constraint for every combination of their aliases.
    listed = trips.sparkSession.range(1).select(F.explode(F.lit(list(hot)).cast("array<bigint>")).alias("_record_key"))
    hot_keys = F.broadcast(listed) if len(hot) <= BROADCAST_KEYS else listed
    usual = _rank_together(keyed.join(hot_keys, "_record_key", "left_anti"), buckets, days)
    split = _rank_in_slices(keyed.join(hot_keys, "_record_key", "left_semi"), slice_rows)
    return usual.unionByName(split)


def _rank_together(keyed: DataFrame, buckets: Column | None, days: DayPlaces | None) -> DataFrame:
    """One shuffle: rows move by record key, by month and bucket of that key, or by month and pickup day.

    The place is a single column, never a constant, so the window below accepts the shuffle.
    """
    if days is not None:
        place = "_place"
        placed = _by_day(keyed, place, buckets, days).withColumn("_record_key", record_key())
    elif buckets is not None:
        place = "_place"
        placed = keyed.withColumn(place, F.xxhash64(*MONTH_COLUMNS, F.pmod("_record_key", buckets))).repartition(place)
    else:
        place = "_record_key"
        placed = keyed.repartition(place)
    keys = dict.fromkeys([place, *RECORD])
    order = Window.partitionBy(*keys).orderBy("source_file", "source_row_number")
    ranked = with_record_hash(placed).withColumn("duplicate_rank", F.row_number().over(order).cast("bigint"))
    return ranked.select(*[name for name in keyed.columns if name != "_record_key"], "stable_record_hash", "duplicate_rank")


def _by_day(keyed: DataFrame, place: str, buckets: Column | None, days: DayPlaces) -> DataFrame:
    """Rows shuffled by month and pickup day, very large days in parts by record key. The key itself, which compresses badly, stays behind."""
    part = F.lit(0).cast("bigint")
    if days.parts:
        lookup = F.create_map(*[F.lit(item) for pair in days.parts.items() for item in pair])
        part = F.pmod("_record_key", F.coalesce(lookup[_day_of_month()], F.lit(1)).cast("bigint"))
    group = F.xxhash64(_pickup_day(), part)
    if buckets is not None:
        group = F.pmod(group, buckets)
    number = F.pmod(F.xxhash64(*MONTH_COLUMNS, group), F.lit(PLACES)).cast("int").alias(place)
    first = [name for name in (*MANY_VALUES, *SOME_VALUES) if name in keyed.columns]
    rest = [name for name in keyed.columns if name not in (*first, "_record_key")]
    tasks = [] if days.tasks is None else [days.tasks]
    return keyed.select(*first, *rest, number).repartition(*tasks, place)


def _rank_in_slices(keyed: DataFrame, slice_rows: int) -> DataFrame:
    """Rank inside slices of the file order, then add the copies counted in earlier slices."""
    slice_keys = [*RECORD, "source_file", "_slice"]
    sliced = with_record_hash(keyed).withColumn("_slice", F.floor(F.col("source_row_number") / slice_rows))
    inside = Window.partitionBy(*slice_keys).orderBy("source_row_number")
    earlier = (
        Window.partitionBy(*RECORD)
        .orderBy("source_file", "_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy(*slice_keys)
        .agg(F.count("*").alias("_copies"))
        .select(*slice_keys, F.coalesce(F.sum("_copies").over(earlier), F.lit(0)).alias("_before"))
    )
    ranked = sliced.withColumn("_inside", F.row_number().over(inside)).join(offsets, slice_keys)
    return ranked.withColumn("duplicate_rank", F.col("_before") + F.col("_inside")).drop(
        "_record_key", "_slice", "_inside", "_before"
    )
