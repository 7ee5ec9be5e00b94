"""Benchmark decontamination: SimHash of item-sized windows, a multi-index Hamming lookup, and exact verification.

Texts are cut into words at white space and ASCII punctuation, A-Z lowered. A window verifies against an item if their
weighted shingle similarity (sum of least counts over sum of largest counts of five-word shingles) reaches the
threshold. Such a window has the item's size and at least one of its shingles, so only windows around shared shingles
get a fingerprint; nothing that could verify is left out by that. Fingerprints have 128 bits in ten blocks. A fingerprint
within the radius of an item's has a block with at most radius // 10 errors, and the index holds every such
block value of every item: all fingerprints within the radius are found. Those are then verified exactly.
A window of similarity 0.8 lies about 19 bits from its item; the radius of 39 is five standard deviations away.

The benchmark is broadcast in blocks of bounded size; a larger one means more blocks, each a pass over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import stored
from tripmart.llm.textops import SPACE, Words, mix, slices, windows

SEPARATORS = SPACE.copy()
SEPARATORS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
BITS, BLOCKS = 128, 10
_EDGES = np.linspace(0, BITS, BLOCKS + 1).astype(int)


@dataclass(frozen=True)
class Decontaminate:
    shingle_words: int = 5
    percent: int = 80
    radius: int = 39
    block_chars: int = 500_000


def _signs(hashes: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 for each shingle hash."""
    both = np.stack([mix(hashes), mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))], axis=1)
    bits = np.unpackbits(both.view(np.uint8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Bits of SimHash from the sums of the signs."""
    return (sums > 0).astype(np.uint8)


def _block_values(bits: np.ndarray) -> np.ndarray:
    """Value of each block of each fingerprint."""
    values = np.zeros((len(bits), BLOCKS), np.int64)
    for k in range(BLOCKS):
        part = bits[:, _EDGES[k] : _EDGES[k + 1]]
        values[:, k] = part @ (1 << np.arange(part.shape[1], dtype=np.int64))
    return values


class HammingIndex:
    """For each block, items by every block value within the allowed errors."""

    def __init__(self, bits: np.ndarray, radius: int):
        self.bits, self.radius = bits, radius
        values = _block_values(bits)
        self.begin, self.items = [], []
        for k in range(BLOCKS):
            width = int(_EDGES[k + 1] - _EDGES[k])
            errors = [sum(1 << b for b in flips) for n in range(min(radius // BLOCKS, width) + 1) for flips in combinations(range(width), n)]
            keys = (values[:, k, None] ^ np.array(errors, np.int64)).reshape(-1)
            order = np.argsort(keys, kind="stable")
            self.begin.append(np.searchsorted(keys[order], np.arange((1 << width) + 1)))
            self.items.append((order // len(errors)).astype(np.int32))

    def near(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, item, distance) of all pairs within the radius."""
        values = _block_values(bits)
        pairs = []
        for k in range(BLOCKS):
            first, last = self.begin[k][values[:, k]], self.begin[k][values[:, k] + 1]
            count = last - first
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            pairs.append(np.repeat(np.arange(len(bits)), count) * len(self.bits) + self.items[k][place])
        pairs = np.unique(np.concatenate(pairs))
        window, item = pairs // len(self.bits), pairs % len(self.bits)
        distance = np.concatenate([np.count_nonzero(bits[window[n : n + 65536]] != self.bits[item[n : n + 65536]], axis=1) for n in range(0, len(pairs), 65536)] or [np.zeros(0, int)])
        near = distance <= self.radius
        return window[near], item[near], distance[near]


class Items:
    """A block of benchmark items: shingle counts, fingerprints, and an index from shingle to item."""

    def __init__(self, rows: list[tuple[int, str]], params: Decontaminate):
        self.params = params
        ids, texts = zip(*rows) if rows else ((), ())
        self.ids, self.sizes, self.shingle_sizes, self.counts, bits, shingles, owners = [], [], [], [], [], [], []
        for first, last, data, offsets in slices(pa.array(texts, pa.string())):
            words = Words(data, offsets, SEPARATORS)
            hashes = words.hashes(lower=True)
            for k in range(last - first):
                own = hashes[words.first[k] : words.first[k + 1]]
                if not len(own):
                    continue
                size = min(params.shingle_words, len(own))
                values, _ = windows(own, np.zeros(len(own), np.int64), size)
                values = values ^ np.uint64(size)
                owners.append(np.full(len(values), len(self.ids)))
                shingles.append(values)
                self.ids.append(ids[first + k])
                self.sizes.append(len(own))
                self.shingle_sizes.append(size)
                self.counts.append(Counter(values.tolist()))
                bits.append(fingerprints(_signs(values).sum(0, dtype=np.int32)))
        shingles = np.concatenate(shingles) if shingles else np.zeros(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(shingles, kind="stable")
        self.shingles, self.owners = shingles[order], owners[order]
        self.mark = np.zeros(1 << 20, bool)
        self.mark[self.shingles >> np.uint64(44)] = True
        self.index = HammingIndex(np.array(bits, np.uint8).reshape(-1, BITS), params.radius)

    def anchors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in values, item) for every shingle that an item has."""
        maybe = np.flatnonzero(self.mark[values >> np.uint64(44)])
        first = np.searchsorted(self.shingles, values[maybe], "left")
        count = np.searchsorted(self.shingles, values[maybe], "right") - first
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return np.repeat(maybe, count), self.owners[place]

    def similarity(self, item: int, values: np.ndarray) -> tuple[int, int]:
        """Sum of least and of largest shingle counts."""
        counts, own = self.counts[item], Counter(values.tolist())
        least = sum(min(n, counts.get(value, 0)) for value, n in own.items())
        return least, len(values) + counts.total() - least

    def matches(self, values: np.ndarray, size: int) -> Iterator[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window for each item, from one text's shingles of one size."""
        place, item = self.anchors(values)
        best: dict[int, tuple[float, int, int]] = {}
        for own in np.unique(item):
            if self.shingle_sizes[own] != size:
                continue
            spread = min(self.sizes[own] - size + 1, len(values))  # shingles of a window
            hits = np.unique(place[item == own])
            starts = np.unique(np.clip(hits[:, None] - np.arange(spread), 0, len(values) - spread))
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > spread) + 1):
                low, high = run[0], run[-1] + spread
                sums = np.zeros((high - low + 1, BITS), np.int32)
                np.cumsum(_signs(values[low:high]), axis=0, dtype=np.int32, out=sums[1:])
                bits = fingerprints(sums[run - low + spread] - sums[run - low])
                window, found, _ = self.index.near(bits)
                for start, near in zip(run[window].tolist(), found.tolist()):
                    if self.shingle_sizes[near] != size or min(self.sizes[near] - size + 1, len(values)) != spread:
                        continue
                    least, most = self.similarity(near, values[start : start + spread])
                    if 100 * least >= self.params.percent * most:
                        rank = (least / most, -start, spread + size - 1)
                        best[near] = max(best.get(near, rank), rank)
        for near, (similarity, start, length) in sorted(best.items()):
            yield near, similarity, -start, length


def leak_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        sizes = sorted(set(items.shingle_sizes))
        for batch in batches:
            found = []
            for first, _, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets, SEPARATORS)
                hashes = words.hashes(lower=True)
                for size in sizes:
                    values, at = windows(hashes, words.row, size)
                    values = values ^ np.uint64(size)
                    row = words.row[at]
                    for own in np.unique(row[items.anchors(values)[0]]).tolist():
                        begin, end = np.searchsorted(row, [own, own + 1])
                        doc = batch.column(0)[first + own].as_py()
                        found += [(doc, items.ids[item], *match) for item, *match in items.matches(values[begin:end], size)]
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], ["doc_id", "item_id", "similarity", "first_word", "n_words"])

    return rows


def leaks(docs: DataFrame, benchmark: DataFrame, params: Decontaminate = Decontaminate()) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) for every document and item that a window of it verifies against.

    The window named is the most similar one, the first of equals. Null or blank texts and items match nothing; items
    shorter than a shingle match as whole sequences, texts shorter than an item are one window. Items without id are ignored;
    rows that repeat an item id give their own rows. Documents are judged row by row, also without id. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("item_id is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = math.ceil(total / params.block_chars) or 1
    parts = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        if rows:
            shared = docs.sparkSession.sparkContext.broadcast(Items([tuple(row) for row in rows], params))
            parts.append(docs.mapInArrow(leak_rows(shared), "doc_id long, item_id long, similarity double, first_word long, n_words long"))
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long, n_words long")
    return reduce(DataFrame.unionByName, parts)


def without_leaks(docs: DataFrame, benchmark: DataFrame, params: Decontaminate = Decontaminate()) -> DataFrame:
    """The documents in which no item is found; columns as they were. Rows without id stay."""
    found = stored(leaks(docs, benchmark, params).select("doc_id").where("doc_id is not null").distinct(), "leaks")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
