"""Main text of web pages by a site style tree.

The DOMs of a host are merged by style path (tags and class words from the root), named parts with all others. A node's presentation
importance is the entropy of the child sequences it has on the host's pages. Its content features are the phrases of its texts (between
marks) and the targets of its links. A feature on k of the node's pages has the entropy log k, so it is spread over exp(entropy) = k pages; content
importance is one minus the mean share of pages that the features met on a page are spread over, scaled so that features of single pages give one, with one
more page of own features added, since few pages say little. It does not depend on the number of pages otherwise, and a menu or footer in which some
entries change still counts little. A node's importance weighs its own
presentation against its children's importance.

A page loses its branches of low importance first. Where that would leave nothing, its host holds mostly copies of the page, and the tree has no
say on it. Then go the parts that are never main text even where they change on every page: menus, headers, footers, sidebars,
notices, adverts, forms and comments, told by element, role or class, and lists of links. Of the rest a page keeps its main part
(article or main elements) where there is any.

Merging is one aggregation by (host, path, feature), combined before the shuffle; a host with many pages is spread by
its paths and features. Nodes on at least `node_pages` pages (or all pages of a smaller host) are judged, however many pages the host has; importances are folded by joins
on (host, path), so no task holds a host's tree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.page_tree import INLINE, Element, Reader
from tripmart.llm.tables import stored

NODE, SHAPE, TEXT = 0, 1, 2
_MARKS = re.compile(r"[.,;:!?]+\s+|\s+[^\w\s]\s+")


@dataclass(frozen=True)
class SiteStyle:
    min_pages: int = 2
    node_pages: int = 3
    least_importance: float = 0.7
    own_weight: float = 0.1
    link_share: float = 0.8
    min_links: int = 3


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _content(elements: list[Element], k: int, feature: str) -> tuple[int, int, int, int]:
    """A content feature, held by the block element that the k-th element is in."""
    while elements[k].tag in INLINE:
        k = elements[k].parent
    own = elements[k]
    return own.path, elements[own.parent].path if own.parent >= 0 else 0, TEXT, _hash(feature)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to the distinct (host, path, parent, kind, feature) of each page."""
    reader = Reader()
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.int64())
    names = ["host", "path", "parent", "kind", "feature"]
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [], [], [])
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            elements, blocks = reader.read(page.as_py() or "")
            found = set()
            for k, own in enumerate(elements):
                if own.target:
                    found.add(_content(elements, k, "href " + own.target))
                if own.tag in INLINE:
                    continue
                parent = elements[own.parent].path if own.parent >= 0 else 0
                found.add((own.path, parent, NODE, 0))
                if own.children:
                    found.add((own.path, parent, SHAPE, _hash("/".join(own.children))))
            for k, text in blocks:
                found.update(_content(elements, k, phrase) for phrase in _MARKS.split(text) if phrase)
            columns[0].extend([host] * len(found))
            for column, values in zip(columns[1:], zip(*found)):
                column.extend(values)
            if len(columns[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)
                columns = ([], [], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)


def style_nodes(pages: DataFrame, params: SiteStyle) -> DataFrame:
    """(host, path, parent, pages, shape, text) of the merged trees: importance of presentation and of own content, null without any."""
    features = pages.where("host is not null").select("host", "html").mapInArrow(_feature_rows, "host string, path long, parent long, kind byte, feature long")
    counts = features.groupBy("host", "path", "parent", "kind", "feature").agg(F.count("*").cast("double").alias("k"))
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    nodes = counts.groupBy("host", "path", "parent").agg(
        of(NODE, F.col("k")).alias("pages"),
        of(SHAPE, F.col("k")).alias("shapes"),
        of(SHAPE, F.col("k") * F.log("k")).alias("shape_sum"),
        of(TEXT, F.col("k")).alias("texts"),
        of(TEXT, F.col("k") * F.col("k")).alias("text_sum"),
    )
    scale = F.log("pages")
    shape = F.when(F.col("pages") > 1, F.greatest((F.log("shapes") - F.col("shape_sum") / F.col("shapes")) / scale, F.lit(0.0))).otherwise(1.0)
    share = F.col("text_sum") / F.col("texts") / F.col("pages")
    text = F.when(F.col("pages") > 1, (F.greatest((1 - share) / (1 - 1 / F.col("pages")), F.lit(0.0)) * F.col("pages") + 1) / (F.col("pages") + 1)).otherwise(1.0)
    nodes = stored(
        nodes.select("host", "path", "parent", "pages", F.when(F.col("shapes") > 0, shape).alias("shape"), F.when(F.col("texts") > 0, text).alias("text")), "style_nodes"
    )
    hosts = nodes.where("path = 0").select("host", F.col("pages").alias("total"))
    judged = F.col("pages") >= F.least(F.lit(float(params.node_pages)), "total")
    return nodes.join(hosts.where(F.col("total") >= params.min_pages), "host").where(judged).drop("total")


def importances(nodes: DataFrame, params: SiteStyle) -> DataFrame:
    """(host, path, parent, importance) of all nodes but the root, from (host, path, parent, shape, text).

    A node's importance is its best text or child, weighed against its own shape: the greatest of one increasing linear function for each
    node below it. Links to ancestors double in length each round, so a tree takes log2(depth) rounds however many nodes a host has.
    """
    own = nodes.where("path <> 0")
    weight = params.own_weight
    above = own.select("host", F.col("path").alias("parent"), F.col("path").alias("jump"), F.when(F.col("shape").isNull(), 1.0).otherwise(1 - weight).alias("slope"), F.coalesce(weight * F.col("shape"), F.lit(0.0)).alias("shift"))
    inner = own.select("host", F.col("parent").alias("path"), F.lit(True).alias("inner")).distinct()
    text = F.coalesce((1 - weight) * F.col("text") + weight * F.col("shape"), "text")
    best = F.when(F.col("inner"), text).otherwise(F.coalesce("text", "shape", F.lit(1.0)))
    state = own.join(inner, ["host", "path"], "left").join(above, ["host", "parent"], "left").select("host", "path", "parent", best.alias("best"), "jump", "slope", "shift")
    state = stored(state, "importance")
    while not state.where("jump is not null").isEmpty():
        gained = state.where("jump is not null").groupBy("host", F.col("jump").alias("path")).agg(F.max(F.col("slope") * F.col("best") + F.col("shift")).alias("gain"))
        ahead = state.select("host", F.col("path").alias("jump"), F.col("jump").alias("next"), F.col("slope").alias("slope2"), F.col("shift").alias("shift2"))
        further = state.join(gained, ["host", "path"], "left").join(ahead, ["host", "jump"], "left")
        state = stored(
            further.select(
                "host", "path", "parent", F.greatest("best", "gain").alias("best"), F.col("next").alias("jump"),
                (F.col("slope") * F.col("slope2")).alias("slope"), (F.col("shift") * F.col("slope2") + F.col("shift2")).alias("shift"),
            ),
            "importance",
        )
    return state.select("host", "path", "parent", F.col("best").alias("importance"))


def low_branches(pages: DataFrame, params: SiteStyle) -> DataFrame:
    """(host, low): style paths of the topmost nodes of low importance, for hosts that have any."""
    low = importances(style_nodes(pages, params), params).where(F.col("importance") < params.least_importance)
    top = low.join(low.select("host", F.col("path").alias("parent")), ["host", "parent"], "left_anti")
    return top.groupBy("host").agg(F.collect_list("path").alias("low"))


def main_text(elements: list[Element], blocks: list[tuple[int, str]], low: frozenset[int], params: SiteStyle) -> str:
    """The kept blocks of one page, joined by one space."""
    repeated, named = [False] * len(elements), [False] * len(elements)
    for k, own in enumerate(elements):
        listing = own.tag in ("ul", "ol", "div", "table", "p") and not own.main and own.links >= params.min_links and own.link_chars >= params.link_share * own.text_chars
        repeated[k] = own.path in low or (own.parent >= 0 and repeated[own.parent])
        named[k] = own.part or listing or (own.parent >= 0 and named[own.parent])
    candidates = [(k, text) for k, text in blocks if not named[k]]
    kept = [(k, text) for k, text in candidates if not repeated[k]] or candidates
    if any(elements[k].main for k, _ in kept):
        kept = [(k, text) for k, text in kept if elements[k].main]
    return " ".join(text for _, text in kept)


def _text_rows(params: SiteStyle):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            texts = []
            for page, low in zip(batch.column(2), batch.column(3).to_pylist()):
                elements, blocks = reader.read(page.as_py() or "")
                texts.append(main_text(elements, blocks, frozenset(low or ()), params))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return rows


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port and user; null where there is none."""
    found = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(found, F.lit(""))


def extract_main_text(pages: DataFrame, params: SiteStyle = SiteStyle()) -> DataFrame:
    """(page_id, url, text) for every row of pages; text is empty where there is no main text.

    Null html counts as empty. Pages without a host, and those of hosts with fewer than `min_pages` pages, have no style tree: only
    the named parts and lists of links are left out of them. Rows are extracted one by one, and each repeated row counts as a page of its
    host. Other columns are ignored; an empty table gives no rows.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of(F.col("url").cast("string")).alias("host"))
    low = stored(low_branches(rows, params), "low_branches")
    rows = rows.join(low, "host", "left").select("page_id", "url", "html", "low")
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_text_rows(params), f"page_id {kind}, url string, text string")
