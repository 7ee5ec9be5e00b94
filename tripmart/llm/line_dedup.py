"""Site-relative line frequency: drop the lines that more than a given share of a site's pages carry.

Only DataFrame functions. A page's distinct lines leave the scan as 64-bit hashes with a second 32-bit hash, so no
text is shuffled to count them; counts are combined before the shuffle, and the key (site, line) splits a
large site over all tasks. A site's list of boilerplate lines is bounded: at most (mean lines of a page / ratio) entries.
Sites' lists are joined to the pages without a hint: Spark broadcasts them when they are small and else splits large sites at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import stored


@dataclass(frozen=True)
class LineDedup:
    ratio_percent: int = 7
    min_pages: int = 3


WORD = "[^ \\t-\\r]"


def _line_key(line: Column) -> Column:
    """96 bits of a line as text-free key; equal keys mean equal lines."""
    return F.struct(F.xxhash64(line).alias("wide"), F.hash(line).alias("narrow"))


def boilerplate_lines(docs: DataFrame, params: LineDedup, host_col: str, text_col: str) -> DataFrame:
    """(site, keys): the keys of the lines that exceed the ratio on each site."""
    pages = docs.where(F.col(host_col).isNotNull()).select(F.col(host_col).alias("site"), F.col(text_col).alias("text"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(WORD))
    keys = F.array_distinct(F.transform(lines, _line_key))
    # The empty key in front stands for the page itself, so pages and lines are counted in one pass.
    page = F.array(F.struct(F.lit(None).cast("long").alias("wide"), F.lit(None).cast("int").alias("narrow")))
    each = pages.select("site", F.inline(F.concat(page, keys)))
    counts = stored(each.groupBy("site", "wide", "narrow").agg(F.count("*").alias("pages")).where(f"wide is null or pages >= {params.min_pages}"), "line_pages")
    totals = counts.where("wide is null").select("site", F.col("pages").alias("total"))
    often = counts.where("wide is not null").join(totals, "site").where(f"100 * pages > {params.ratio_percent} * total")
    return often.groupBy("site").agg(F.sort_array(F.collect_list(F.struct("wide", "narrow"))).alias("keys"))


def drop_boilerplate(docs: DataFrame, params: LineDedup = LineDedup(), host_col: str = "source", text_col: str = "text") -> DataFrame:
    """docs with boilerplate lines removed from the text, other columns as they were, plus `lines_dropped`.

    A line is dropped where it stands on at least `min_pages` pages of its site and on more than `ratio_percent` of
    them; a page counts once however often it repeats the line, and each row is a page. Lines without a word are
    never dropped. Null text stays null, a page without a site keeps its lines, and an empty table gives no rows. A column
    `lines_dropped` of docs is replaced.
    """
    frequent = stored(boilerplate_lines(docs, params, host_col, text_col), "boilerplate").withColumnsRenamed({"site": "__site", "keys": "__keys"})
    # Columns travel in one struct, so no name of docs can clash with the names used here.
    rows = docs.select(F.struct("*").alias("__row"), F.col(host_col).alias("__site"))
    rows = rows.join(frequent, "__site", "left")
    text = F.col("__row").getField(text_col)
    lines = F.split(text, "\n")
    held = F.filter(lines, lambda line: ~(line.rlike(WORD) & F.array_contains(F.col("__keys"), _line_key(line))))
    cleaned = F.when(F.col("__keys").isNull() | text.isNull(), text).otherwise(F.array_join(held, "\n"))
    dropped = F.when(F.col("__keys").isNull() | text.isNull(), 0).otherwise(F.size(lines) - F.size(held)).cast("long")
    columns = [cleaned.alias(name) if name == text_col else F.col("__row").getField(name).alias(name) for name in docs.columns if name != "lines_dropped"]
    return rows.select(*columns, dropped.alias("lines_dropped"))
