"""Periodic runs of words: suffix-tree extensions of Lyndon roots.

A run is a maximal stretch of words with a smallest period. Each run contains a Lyndon root, which is the longest Lyndon word at its
first position under the order of the words or under the reversed order. So two candidates a position are enough: the
longest Lyndon word there under either order, found from suffix ranks as the distance to the next smaller suffix. A
candidate is extended to the right by the longest common extension of its two ends in a suffix tree of the words, and to the left by the
one in a suffix tree of the reversed words. Trees are built by Ukkonen's algorithm; an Euler tour of the tree keeps the lowest
node between neighbouring leaves, and a sparse table over it answers lowest common ancestors in constant time, for all candidates at once.

Only stretches that can hold a run get trees. In a run of at least four periods every pair of neighbouring words occurs three times inside the run, so
pairs that occur less often in their stretch cut it; this is repeated until nothing changes and leaves no run out. Words are compared by their bytes in the trees.
Documents are independent: one pass over the rows, no shuffle. Memory is bounded by a slice of rows or one long text and its trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textops import Words, mix, slices

RUNS = "array<struct<start: long, length: long, period: long>>"


@dataclass(frozen=True)
class PeriodicRuns:
    """A run has at least `least_words` words and `least_periods` periods (three or more)."""

    least_words: int = 6
    least_periods: int = 4

    def __post_init__(self):
        if self.least_periods < 3 or self.least_words < 2:
            raise ValueError("runs need at least three periods and two words")


def suffix_tree(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Ukkonen's tree of a sequence whose last symbol occurs once: (parent, first symbol, edge start, edge end) of nodes 1.., and the node count.

    Node 0 is the root; a leaf's edge ends with the sequence.
    """
    n = len(symbols)
    start, end, link, parent = [0], [0], [0], [-1]
    child: dict[int, int] = {}
    node = edge = length = waiting = 0
    for at in range(n):
        symbol = symbols[at]
        waiting += 1
        last = -1
        while waiting:
            if not length:
                edge = at
            key = node << 32 | symbols[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(at)
                end.append(n)
                link.append(0)
                parent.append(node)
                if last >= 0:
                    link[last] = node
                    last = -1
            else:
                stop = end[below]
                span = (stop if stop <= at else at + 1) - start[below]
                if length >= span:
                    node, edge, length = below, edge + span, length - span
                    continue
                if symbols[start[below] + length] == symbol:
                    length += 1
                    if last >= 0:
                        link[last] = node
                    break
                split = len(start)
                begin = start[below]
                child[key] = split
                start.append(begin)
                end.append(begin + length)
                link.append(0)
                parent.append(node)
                child[split << 32 | symbol] = split + 1
                start.append(at)
                end.append(n)
                link.append(0)
                parent.append(split)
                start[below] = begin + length
                parent[below] = split
                child[split << 32 | symbols[begin + length]] = below
                if last >= 0:
                    link[last] = split
                last = split
            waiting -= 1
            if not node and length:
                length -= 1
                edge = at - waiting + 1
            elif node:
                node = link[node]
    begins = np.array(start[1:], np.int64)
    return np.array(parent[1:], np.int64), np.array(symbols, np.int64)[begins], begins, np.array(end[1:], np.int64), len(start)


class Extensions:
    """Suffix ranks and longest common extensions of a sequence of numbers from 1 on."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        tree = suffix_tree([*symbols.tolist(), 0])
        self.rank, low = self._tour(tree, n + 1, tree[1])
        self.tree = tree
        # Sparse table: minima of the lowest depths over 2**k neighbouring gaps.
        self.table = [low]
        while 2 << len(self.table) - 1 <= len(low):
            row, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(row[:-half], row[half:]))

    @staticmethod
    def _tour(tree, n: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each suffix in an Euler tour that enters children by `order`, and the depth of the lowest node between neighbouring leaves."""
        parent, _, begin, end, nodes = tree
        sorted_nodes = np.lexsort((-order, parent))  # a stack gives them back in ascending order
        first = np.searchsorted(parent[sorted_nodes], np.arange(nodes + 1)).tolist()
        below = (sorted_nodes + 1).tolist()
        span = [0, *(end - begin).tolist()]
        depth = [0] * nodes
        above = [-1, *parent.tolist()]
        rank, low, lowest = np.zeros(n, np.int64), [], 0
        placed = 0
        stack = below[first[0] : first[1]]
        previous = 0
        while stack:
            node = stack.pop()
            top = above[node]
            if top != previous:
                lowest = depth[top]
            depth[node] = here = depth[top] + span[node]
            a, b = first[node], first[node + 1]
            if a < b:
                stack += below[a:b]
                previous = node
            else:
                if placed:
                    low.append(lowest)
                rank[n - here] = placed
                placed += 1
                previous = -1
        return rank, np.array(low, np.int32)

    def reversed_rank(self) -> np.ndarray:
        """Ranks under the reversed order of symbols; the end stays smallest."""
        symbol = self.tree[1]
        return self._tour(self.tree, self.n + 1, np.where(symbol == 0, -(1 << 62), -symbol))[0]

    def common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at two different positions (up to n, where the suffix is empty)."""
        left, right = self.rank[one], self.rank[other]
        left, right = np.minimum(left, right), np.maximum(left, right)
        level = np.frexp((right - left).astype(float))[1] - 1
        found = np.zeros(len(left), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.table[k]
            found[at] = np.minimum(row[left[at]], row[right[at] - (1 << k)])
        return found


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each position the next one whose rank is smaller, for all but the last (which has the smallest)."""
    ranks = rank.tolist()
    found = [0] * (len(ranks) - 1)
    stack = [len(ranks) - 1]
    for at in range(len(ranks) - 2, -1, -1):
        own = ranks[at]
        while ranks[stack[-1]] > own:
            stack.pop()
        found[at] = stack[-1]
        stack.append(at)
    return np.array(found, np.int64)


def runs_of(symbols: np.ndarray, params: PeriodicRuns) -> np.ndarray:
    """(start, length, period) of the runs of a sequence of numbers from 1 on, by start and period."""
    n = len(symbols)
    if n < params.least_words:
        return np.zeros((0, 3), np.int64)
    ahead, back = Extensions(symbols), Extensions(symbols[::-1])
    begin = np.tile(np.arange(n), 2)
    second = np.concatenate([next_smaller(ahead.rank), next_smaller(ahead.reversed_rank())])
    period = second - begin
    right = ahead.common(begin, second)
    able = np.flatnonzero(period * (params.least_periods - 1) <= right + begin)  # the left extension has at most `begin` words
    begin, second, period, right = begin[able], second[able], period[able], right[able]
    left = back.common(n - begin, n - second)
    start, length = begin - left, left + period + right
    held = (length >= params.least_words) & (length >= params.least_periods * period)
    found = np.stack([start, length, period], 1)[held]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def able_stretches(hashes: np.ndarray, row: np.ndarray, params: PeriodicRuns) -> list[tuple[int, int]]:
    """Stretches of words (first, end) that may hold a run; every run of a row lies in one of them."""
    at = np.flatnonzero(row[1:] == row[:-1])
    group = row[at].astype(np.uint64)
    pair = mix(hashes[at] * np.uint64(0xA0761D6478BD642F) ^ hashes[at + 1]) if len(at) else np.zeros(0, np.uint64)
    least = params.least_words - 1
    while len(at):
        _, number, count = np.unique(pair ^ mix(group + np.uint64(1)), return_inverse=True, return_counts=True)
        held = count[number] >= params.least_periods - 1
        before = len(at)
        at, pair, group = at[held], pair[held], group[held]
        if not len(at):
            break
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1])
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, len(at)))
        number = np.repeat(np.arange(len(first)), size)
        long = size[number] >= least
        at, pair, group = at[long], pair[long], number[long].astype(np.uint64)
        if len(at) == before:
            break
    if not len(at):
        return []
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    last = np.append(first[1:], len(at)) - 1
    return list(zip(at[first].tolist(), (at[last] + 2).tolist()))


def run_rows(params: PeriodicRuns):
    """Arrow batches of (key, text) to (key, n_words, runs, collapsed)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                yield described(batch.column(0).slice(first, last - first), data, offsets)

    def described(keys: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        words = Words(data, offsets)
        number = len(words.first) - 1
        kept = np.ones(len(words.begin), bool)
        found, owner = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)]
        raw = data.tobytes()
        for begin, end in able_stretches(words.hashes(), words.row, params):
            codes: dict[bytes, int] = {}
            spelled = (raw[a:b] for a, b in zip(words.begin[begin:end].tolist(), words.end[begin:end].tolist()))
            runs = runs_of(np.array([codes.setdefault(word, len(codes) + 1) for word in spelled], np.int64), params)
            for start, length, period in runs.tolist():
                kept[begin + start + period : begin + start + length] = False
            row = words.row[begin]
            found.append(runs + np.array([begin - words.first[row], 0, 0]))
            owner.append(np.full(len(runs), row))
        runs, row = np.concatenate(found), np.concatenate(owner)
        ends = np.searchsorted(row, np.arange(number + 1)).astype(np.int32)
        items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(column)) for column in runs.T], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(ends), items), joined(words, kept, data)],
            ["key", "n_words", "runs", "collapsed"],
        )

    return rows


def joined(words: Words, kept: np.ndarray, data: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    number = len(words.first) - 1
    begin, row = words.begin[kept], words.row[kept]
    size = words.end[kept] - begin + 1  # with the space after it
    out = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    padded = np.append(data, np.uint8(0x20))
    text = padded[np.repeat(begin - out[:-1], size) + np.arange(out[-1])]
    text[out[1:] - 1] = 0x20
    place = np.searchsorted(row, np.arange(number + 1))
    ends = out[place]
    # The space after a row's last word goes.
    last = out[place[1:]][np.diff(place) > 0] - 1
    whole = np.ones(len(text), bool)
    whole[last] = False
    ends = ends - np.concatenate([[0], np.cumsum(np.diff(place) > 0)])
    return pa.LargeStringArray.from_buffers(number, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text[whole])).cast(pa.string())


def periodic_runs(docs: DataFrame, params: PeriodicRuns = PeriodicRuns(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n_words, runs, collapsed) for every row of docs, `key` being its id.

    `runs` lists (start, length, period) by start, then period, start counted in words from 0. `collapsed` is the text's words joined by one space,
    without those that any run contains after its first period. Null and blank texts have no words, no runs
    and an empty collapsed text. Rows are independent, so repeated rows and null ids need no rule; other columns are
    ignored, and an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run_rows(params), f"key {kind}, n_words long, runs {RUNS}, collapsed string")
