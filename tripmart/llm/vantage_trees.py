"""Nearest neighbours by inner product in vantage-point trees, one tree for each shard of the vectors.

Largest inner product becomes nearest distance: with M the largest norm, a vector x gets one more component sqrt(M^2 - |x|^2) and a query
gets 0 there, so the squared distance is |q|^2 + M^2 - 2 q.x. Vectors go to the cell of their nearest pivot; a cell is dealt over
as many shards as keep a shard near `shard_rows`, and each shard has a tree. A node splits its points at the median distance
to a vantage point and keeps the range of distances on both sides. By the triangle inequality no point of a side is nearer to the query than
the gap between the query's own distance to the vantage point and that range. A side (or a whole cell, by its range of distances to its pivot)
is left out if `factor` times that gap exceeds the distance of the k-th neighbour found so far. Factor 1 gives exact search; larger factors prune more.
Vectors of 64 components without strong clusters have small gaps: exact search then compares nearly all pairs, and a factor of 5 nine tenths of them.

A query first searches its own cell, which gives it a k-th neighbour, then all other cells that are not pruned. Queries meet a shard in
blocks, so a group holds one shard and one block. Scores of candidates are sums over components in order, on the original vectors in double
precision. Equal vectors are one point with its k + 1 smallest ids, since no other id of it can be among k neighbours; so a large group of copies
costs one point. Only pivots (a sample bounded by `pivots`) and a range for each cell reach the driver.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.tables import bounded_rows, stored


@dataclass(frozen=True)
class VpSearch:
    neighbours: int = 20
    factor: float = 5.0
    pivots: int = 1024
    shard_rows: int = 4096
    leaf_rows: int = 128
    block_queries: int = 2048


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) of each vector length in a column."""
    lengths = np.diff(column.offsets.to_numpy())
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield length, at, matrix(column.take(pa.array(at)))


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices, summed over components in order."""
    total = np.zeros(len(one))
    for k in range(one.shape[1]):
        total += one[:, k] * other[:, k]
    return total


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that gives all of them the norm sqrt(most)."""
    return np.concatenate([vectors, np.sqrt(np.maximum(most - np.einsum("ij,ij->i", vectors, vectors), 0))[:, None]], 1)


def gaps(distance: np.ndarray, low, high) -> np.ndarray:
    """How far a query at this distance from the middle is from all points in a range of distances, at least."""
    return np.maximum(np.maximum(distance - high, low - distance), 0)


class Tree:
    """Vantage-point tree over distinct vectors, each with a few ids."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], most: float, leaf_rows: int):
        self.most = most
        order = np.arange(len(vectors))
        raised = lifted(vectors, most)
        draw = np.random.default_rng(len(vectors))
        vantage: list[np.ndarray] = []
        self.leaves: list[tuple[int, int]] = []  # first and end of their points
        self.sides: list[tuple[int, float, float, int, int]] = []  # vantage point, range of distances, first and end of the leaves below

        def divide(first: int, end: int) -> None:
            if end - first <= leaf_rows:
                self.leaves.append((first, end))
                return
            own = order[first:end]
            middle = raised[own[draw.integers(len(own))]]
            # The point farthest from a random one lies at the rim, where ranges of distances are narrow.
            middle = raised[own[np.argmax(((raised[own] - middle) ** 2).sum(1))]]
            distance = np.sqrt(((raised[own] - middle) ** 2).sum(1))
            place = np.argsort(distance, kind="stable")
            order[first:end], distance = own[place], distance[place]
            number, half = len(vantage), len(own) // 2
            vantage.append(middle[:-1])
            for begin, stop in ((0, half), (half, len(own))):
                before = len(self.leaves)
                divide(first + begin, first + stop)
                self.sides.append((number, float(distance[begin]), float(distance[stop - 1]), before, len(self.leaves)))

        divide(0, len(vectors))
        self.vantage = np.array(vantage).reshape(-1, vectors.shape[1])
        self.vectors = vectors[order]
        self.norm = float(np.sqrt((vectors**2).sum(1).max()))
        lists = [ids[k] for k in order.tolist()]
        self.first_id = np.concatenate([[0], np.cumsum([len(own) for own in lists])])
        self.ids = np.array([one for own in lists for one in own], np.int64)


class Search:
    """A block of queries in one tree."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, params: VpSearch):
        self.tree, self.own, self.queries, self.params = tree, ids, queries, params
        self.square = np.einsum("ij,ij->i", queries, queries)
        self.slack = 1e-9 * (np.sqrt(self.square) * tree.norm) + 1e-300
        self.floor = floor  # scores below it are of no use to the query
        self.scores = np.full((len(queries), params.neighbours), -np.inf)
        self.found = np.full((len(queries), params.neighbours), np.iinfo(np.int64).max)
        self.compared = 0

    def run(self) -> Search:
        gap = self.leaf_gaps()
        nearest = gap.argmin(1)
        for k in np.unique(nearest).tolist():
            self.compare(*self.tree.leaves[k], np.flatnonzero(nearest == k))
        for k in np.argsort(np.median(gap, 0), kind="stable").tolist():
            reach = np.sqrt(np.maximum(self.square + self.tree.most - 2 * (self.least(slice(None)) - self.slack), 0))
            active = np.flatnonzero((nearest != k) & ~(self.params.factor * gap[:, k] > reach * (1 + 1e-9)))
            if len(active):
                self.compare(*self.tree.leaves[k], active)
        return self

    def leaf_gaps(self) -> np.ndarray:
        """Each query's gap to every leaf: the largest one on the way down to it."""
        tree = self.tree
        distance = np.sqrt(np.maximum(self.square[:, None] + tree.most - 2 * self.queries @ tree.vantage.T, 0))
        found = np.zeros((len(self.queries), len(tree.leaves)))
        for vantage, low, high, first_leaf, end_leaf in tree.sides:
            side = found[:, first_leaf:end_leaf]
            np.maximum(side, gaps(distance[:, vantage], low, high)[:, None], out=side)
        return found

    def least(self, active) -> np.ndarray:
        return np.maximum(self.scores[active, -1], self.floor[active])

    def compare(self, first: int, end: int, active: np.ndarray) -> None:
        self.compared += len(active) * (end - first)
        about = self.queries[active] @ self.tree.vectors[first:end].T
        least, slack = self.least(active), self.slack[active]
        if end - first > self.params.neighbours + 1:
            # The query's own point may be among them, so one more than the neighbours.
            least = np.maximum(least, np.partition(about, -self.params.neighbours - 1, 1)[:, -self.params.neighbours - 1] - slack)
        row, column = np.nonzero(~(about < (least - slack)[:, None]))
        if not len(row):
            return
        query, point = active[row], first + column
        score = np.concatenate([products(self.queries[query[k : k + 32768]], self.tree.vectors[point[k : k + 32768]]) for k in range(0, len(query), 32768)])
        count = np.diff(self.tree.first_id)[point]
        at = np.repeat(self.tree.first_id[point] - np.cumsum(count) + count, count) + np.arange(count.sum())
        query, score, ids = np.repeat(query, count), np.repeat(score, count), self.tree.ids[at]
        held = (ids != self.own[query]) & ~(score < self.floor[query])
        self.merge(query[held], score[held], ids[held])

    def merge(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, place = np.unique(query, return_inverse=True)
        k = self.params.neighbours
        place = np.concatenate([np.repeat(np.arange(len(touched)), k), place])
        score = np.concatenate([self.scores[touched].ravel(), score])
        ids = np.concatenate([self.found[touched].ravel(), ids])
        order = np.lexsort((ids, -score, place))
        place = place[order]
        rank = np.arange(len(order)) - np.searchsorted(place, np.arange(len(touched)))[place]
        best = order[rank < k]
        self.scores[touched], self.found[touched] = score[best].reshape(-1, k), ids[best].reshape(-1, k)


def usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part; of an id with several vectors the first in array order."""
    rows = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


@dataclass
class Pivots:
    """Sampled vectors, the square of the largest norm, and for each cell its shards and range of distances."""

    vectors: dict[int, np.ndarray]  # by length; cells are numbered through all lengths
    first: dict[int, int]
    most: float
    cells: dict[int, tuple[int, float, float]]

    def distances(self, length: int, rows: np.ndarray, point: bool) -> np.ndarray:
        """Distances of vectors (or of queries) to the pivots of their length."""
        pivots = lifted(self.vectors[length], self.most)
        rows = lifted(rows, self.most) if point else np.concatenate([rows, np.zeros((len(rows), 1))], 1)
        square = np.einsum("ij,ij->i", rows, rows)[:, None] + np.einsum("ij,ij->i", pivots, pivots)[None, :] - 2 * rows @ pivots.T
        return np.sqrt(np.maximum(square, 0))

    def query_gaps(self, length: int, rows: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The cells of a vector length, and each query's gap to them."""
        cells = [c for c in range(self.first[length], self.first[length] + len(self.vectors[length])) if c in self.cells] if length in self.first else []
        found = [np.zeros((len(rows), 0))]
        if cells:
            distance = self.distances(length, rows, False)[:, [c - self.first[length] for c in cells]]
            low, high = (np.array([self.cells[c][k] for c in cells]) for k in (1, 2))
            # Distances differ by rounding between places where they are computed.
            found.append(np.maximum(gaps(distance, low, high) - 1e-7 * (1 + math.sqrt(self.most)), 0) + 1e-12 * distance)
        if -length in self.cells:  # vectors of a length without a pivot
            cells.append(-length)
            found.append(np.zeros((len(rows), 1)))
        return cells, np.concatenate(found, 1)


def _cell_rows(shared):
    """(ids, vector) to (cell, distance, ids, vector)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = cloudpickle.loads(shared.value)
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for length, at, vectors in by_length(batch.column(1)):
                if length not in pivots.vectors:
                    cell[at] = -length
                    continue
                distance = pivots.distances(length, vectors, True)
                nearest = distance.argmin(1)
                cell[at], far[at] = pivots.first[length] + nearest, distance[np.arange(len(at)), nearest]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(far), *batch.columns], ["cell", "distance", "ids", "vector"])

    return rows


def _tree_rows(most: float, leaf_rows: int):
    def rows(table: pa.Table) -> pa.Table:
        vectors = matrix(table.column("vector").combine_chunks())
        tree = Tree(vectors, table.column("ids").to_pylist(), most, leaf_rows)
        return pa.table({"cell": table.column("cell")[:1], "shard": table.column("shard")[:1], "tree": pa.array([cloudpickle.dumps(vars(tree))], pa.binary())})

    return rows


def _route_rows(shared, factor: float, home: bool):
    """(id, vector, floor, home) to (cell, shards, id, vector, floor): the query's own cell, or all others that are not pruned."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = cloudpickle.loads(shared.value)
        for batch in batches:
            floor = batch.column(2).to_numpy(zero_copy_only=False)
            cells, chosen = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for length, at, vectors in by_length(batch.column(1)):
                numbers, gap = pivots.query_gaps(length, vectors)
                if not numbers:
                    continue
                own = gap.argmin(1)
                wanted = np.zeros(gap.shape, bool)
                wanted[np.arange(len(at)), own] = True
                if not home:
                    square = np.einsum("ij,ij->i", vectors, vectors)
                    reach = np.sqrt(np.maximum(square + pivots.most - 2 * floor[at], 0)) * (1 + 1e-9)
                    wanted = ~wanted & ~(factor * gap > reach[:, None])
                row, column = np.nonzero(wanted)
                chosen.append(at[row])
                cells.append(np.array(numbers, np.int32)[column])
            cell, row = np.concatenate(cells), pa.array(np.concatenate(chosen))
            shards = np.array([pivots.cells[c][0] for c in cell.tolist()], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(shards), *(batch.column(k).take(row) for k in range(3))], ["cell", "shards", "id", "vector", "floor"])

    return rows


def _search_rows(params: VpSearch):
    def rows(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out = {name: [] for name in ("query_id", "vec_id", "score")}
        if trees.num_rows and queries.num_rows:
            tree = Tree.__new__(Tree)
            vars(tree).update(pickle.loads(trees.column("tree")[0].as_py()))
            ids, floor = (queries.column(name).to_numpy() for name in ("id", "floor"))
            done = Search(tree, ids, matrix(queries.column("vector").combine_chunks()), floor, params).run()
            row, place = np.nonzero(done.scores > -np.inf)
            out = {"query_id": ids[row], "vec_id": done.found[row, place], "score": done.scores[row, place]}
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    return rows


@dataclass
class Index:
    trees: DataFrame
    pivots: Pivots | None


def build(vectors: DataFrame, params: VpSearch = VpSearch(), id_col: str = "vec_id", vector_col: str = "embedding") -> Index:
    """Trees over all usable vectors, stored; pivots are a hash sample of at most `pivots` vectors."""
    rows = usable(vectors, id_col, vector_col)
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = rows.withColumn("place", place).where(F.col("place") <= params.neighbours + 1)
    points = stored(rows.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("ids", "vector"), "points")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    count, most = points.agg(F.count("*"), F.max(square)).first()
    if not count:
        return Index(points, None)
    wanted = min(params.pivots, math.ceil(count / params.shard_rows))
    sample = bounded_rows(points.select(F.col("ids")[0].alias("key"), "vector"), "key", wanted).collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    first, at = {}, 0
    for length, own in by_size.items():
        first[length] = at
        at += len(own)
    pivots = Pivots({length: np.array(own) for length, own in by_size.items()}, first, float(most), {})
    context = points.sparkSession.sparkContext
    shared = context.broadcast(cloudpickle.dumps(pivots))
    celled = stored(points.mapInArrow(_cell_rows(shared), "cell int, distance double, ids array<long>, vector array<double>"), "cells")
    ranges = celled.groupBy("cell").agg(F.ceil(F.count("*") / params.shard_rows).cast("int").alias("shards"), F.min("distance").alias("low"), F.max("distance").alias("high"))
    ranges = stored(ranges, "ranges")
    pivots.cells = {row["cell"]: (row["shards"], row["low"], row["high"]) for row in ranges.collect()}
    dealt = celled.join(F.broadcast(ranges.select("cell", "shards")), "cell")  # at most `pivots` cells and one for each other vector length
    shard = F.pmod(F.xxhash64(F.col("ids")[0]), F.col("shards")).cast("int").alias("shard")
    trees = dealt.select("cell", shard, "ids", "vector").groupBy("cell", "shard").applyInArrow(_tree_rows(float(most), params.leaf_rows), "cell int, shard int, tree binary")
    return Index(stored(trees, "trees"), pivots)


def _searched(index: Index, routed: DataFrame, params: VpSearch) -> DataFrame:
    """(query_id, vec_id, score) from each shard that a query is sent to."""
    routed = stored(routed.select("cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "id", "vector", "floor"), "routed")
    blocks = routed.groupBy("cell", "shard").agg(F.ceil(F.count("*") / params.block_queries).cast("int").alias("blocks"))
    queries = routed.join(blocks, ["cell", "shard"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    trees = index.trees.join(blocks, ["cell", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    key = ["cell", "shard", "block"]
    found = trees.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(_search_rows(params), "query_id long, vec_id long, score double")
    return stored(found, "found")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, params: VpSearch = VpSearch(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest indexed vectors of each query, its own id left out, ties by smaller id.

    Vectors that are null, empty or zero, or hold null or non-finite components take no part on either side, and neither do rows without id. An id that repeats counts once,
    with the first of its vectors in array order. Only vectors of the query's own length are its candidates; a query with fewer than k of them
    gets all, one without any has no rows. Other columns are ignored, and empty tables give no rows.
    """
    asked = usable(queries, id_col, vector_col)
    spark = queries.sparkSession
    if index.pivots is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = stored(asked, "queries")
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(index.pivots))
    schema = "cell int, shards int, id long, vector array<double>, floor double"
    lowest = F.lit(float("-inf"))
    first = _searched(index, asked.withColumn("floor", lowest).mapInArrow(_route_rows(shared, params.factor, True), schema), params)
    ends = _best(first, params.neighbours).where(F.col("rank") == params.neighbours).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    floors = asked.join(ends, "id", "left").select("id", "vector", F.coalesce("floor", lowest).alias("floor"))
    second = _searched(index, floors.mapInArrow(_route_rows(shared, params.factor, False), schema), params)
    best = _best(first.unionByName(second), params.neighbours)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
