"""Row numbers over a whole input of many files, without a window over its rows.

A row's number is its place in its file plus the rows of all files before it in path order. Rows per file come from
a scan that reads no columns. Files are dealt over ranges of paths; their running totals are taken inside each range, and the ranges'
own totals (one row each) are added in front. So no task sees all files, and no row of the input is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import written

FILE, ROW_IN_FILE = "source_file", "source_row_number"
# Files of one range; a million files make a thousand ranges.
FILES_PER_RANGE = 1000
# Offsets of more files than this are joined by a shuffle.
BROADCAST_FILES = 100_000


def file_counts(rows: DataFrame, file_col: str = FILE) -> DataFrame:
    """(file, rows) of every file that has rows; `rows` is a scan with its file's path as a column."""
    return rows.groupBy(F.col(file_col).alias("file")).agg(F.count("*").alias("rows"))


def file_offsets(counts: DataFrame, files: int | None = None, files_per_range: int = FILES_PER_RANGE) -> DataFrame:
    """(file, rows, rows_before): rows of all files before each one in path order (by bytes).

    `counts` has one row for each file. Where `files` is known and fits one range, nothing runs yet. Else files are
    dealt over ranges, which are fixed by writing them, since another evaluation could draw other bounds.
    The result says how it is to be joined (see with_global_ordinal).
    """
    if files is not None and files <= files_per_range:
        found = _running(counts.withColumn("range", F.lit(0)))
        return _joined_by_size(found.select("file", "rows", F.col("inside").alias("rows_before")), files)
    counts = written(counts, "file-counts")
    files = counts.count()
    ranges = max(1, -(-files // files_per_range))
    dealt = written(counts.repartitionByRange(ranges, "file").withColumn("range", F.spark_partition_id()), "file-ranges")
    # One row for each range, at most files / files_per_range; each is added to the ranges after it.
    totals = dealt.groupBy("range").agg(F.sum("rows").alias("range_rows"))
    later = totals.where(F.col("range") < ranges - 1).select(F.explode(F.sequence(F.col("range") + 1, F.lit(ranges - 1))).alias("range"), "range_rows")
    outside = later.groupBy("range").agg(F.sum("range_rows").alias("outside"))
    found = _running(dealt).join(outside, "range", "left")
    return _joined_by_size(found.select("file", "rows", (F.col("inside") + F.coalesce("outside", F.lit(0))).alias("rows_before")), files)


def _joined_by_size(offsets: DataFrame, files: int) -> DataFrame:
    """Spark can only guess how small offsets are, and rows, whose path is not in the file, look smaller than they are."""
    return F.broadcast(offsets) if files <= BROADCAST_FILES else offsets.hint("merge")


def _running(dealt: DataFrame) -> DataFrame:
    inside = Window.partitionBy("range").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("inside", F.coalesce(F.sum("rows").over(inside), F.lit(0)))


def with_global_ordinal(rows: DataFrame, offsets: DataFrame, name: str = ROW_IN_FILE, file_col: str = FILE, row_col: str = ROW_IN_FILE) -> DataFrame:
    """`rows` with column `name`: 1, 2, ... over all files in path order, without gap.

    `rows` are never the side that is broadcast: offsets of up to BROADCAST_FILES files are, and for more both sides are shuffled, and files
    with many rows split at run time.
    """
    place = offsets.select(F.col("file").alias("_file"), F.col("rows_before").alias("_before"))
    joined = rows.join(place, F.col(file_col) == F.col("_file"))
    return joined.withColumn(name, (F.col("_before") + F.col(row_col)).cast("bigint")).drop("_file", "_before")
