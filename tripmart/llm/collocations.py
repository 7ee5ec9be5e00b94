"""Phrase collocations counted in a prefix-free parse of the corpus.

Texts are cut into pieces, pieces into words. Where the hash of the next `most_words - 1` words in a piece is 0 modulo `modulus`, a new chunk begins and the
chunk before ends after these words, so neighbouring chunks overlap by them and equal passages give equal chunks.
The distinct chunks of a language, with how often the parse holds them, are the dictionary. A phrase belongs to the chunk in
which it begins before the overlap with the next one; so every phrase of at most `most_words` words is counted once for each
occurrence of its chunk, and repeated text is looked at once.

No phrase is more frequent than the words and pairs in it. Frequent words are counted first, then hashes of pairs of these, then the phrases whose pairs all
passed, by their text. What passes from step to step is a bitmap of fixed size, which may let rare phrases through but never stops a
frequent one; final counts are by text and exact. Every step counts on the map side before it shuffles. Nothing else is
broadcast or collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.periodic_runs import joined
from tripmart.llm.tables import stored
from tripmart.llm.textops import Words, mix, slices, windows

BETWEEN_WORDS = np.zeros(256, bool)
BETWEEN_WORDS[[0x20, 0x09]] = True
BETWEEN_PIECES = np.zeros(256, bool)
BETWEEN_PIECES[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
ONE_SPACE = np.zeros(256, bool)
ONE_SPACE[0x20] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Collocations:
    most_words: int = 4
    least_count: int = 30
    covered_percent: int = 80
    top: int = 2000
    modulus: int = 16
    filter_bits: int = 26  # bitmaps have 2**filter_bits bits
    salts: int = 16

    @property
    def overlap(self) -> int:
        return self.most_words - 1


def chunk_rows(params: Collocations):
    """Arrow batches of (lang, text) to (lang, chunk, last): chunks as words joined by one space, and whether the piece ends with it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets, BETWEEN_WORDS | BETWEEN_PIECES)
                n = len(words.begin)
                if not n:
                    continue
                cuts = np.zeros(len(data) + 1, np.int64)
                np.cumsum(BETWEEN_PIECES[data], out=cuts[1:])
                number = cuts[words.begin]
                begins = np.ones(n, bool)
                begins[1:] = (words.row[1:] != words.row[:-1]) | (number[1:] != number[:-1])
                value, at = windows(words.hashes(lower=True), np.cumsum(begins), params.overlap)
                starts = begins.copy()
                starts[at[value % np.uint64(params.modulus) == 0]] = True
                start = np.flatnonzero(starts)
                end = np.append(start[1:], n)
                last = np.append(begins[start[1:]], True)
                end = np.where(last, end, end + params.overlap)
                size = end - start
                before = np.cumsum(size) - size
                index = np.repeat(start - before, size) + np.arange(size.sum())
                chunks = SimpleNamespace(begin=words.begin[index], end=words.end[index], row=np.repeat(np.arange(len(start)), size), first=range(len(start) + 1))
                lang = batch.column(0).take(pa.array(first + words.row[start]))
                yield pa.RecordBatch.from_arrays([lang, joined(chunks, slice(None), _LOWER[data]), pa.array(last)], ["lang", "chunk", "last"])

    return rows


class Chunks:
    """Words of a slice of dictionary rows (lang, chunk, last, times), hashed together with their language."""

    def __init__(self, batch: pa.RecordBatch, first: int, end: int, data: np.ndarray, offsets: np.ndarray, params: Collocations):
        self.words = words = Words(data, offsets, ONE_SPACE)
        self.times = batch.column(3).slice(first, end - first).to_numpy(zero_copy_only=False)
        coded = batch.column(0).slice(first, end - first).dictionary_encode()
        salts = [int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in coded.dictionary.to_pylist()]
        salt = np.array(salts, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]
        self.hashes = mix(words.hashes() ^ salt[words.row])
        last = batch.column(2).slice(first, end - first).to_numpy(zero_copy_only=False)
        # Phrases that begin at or after a row's `stop` belong to the next chunk.
        stop = words.first[1:] - np.where(last, 0, params.overlap)
        self.owned = np.arange(len(words.begin)) < stop[words.row]


def dictionary_rows(work, params: Collocations):
    """Apply `work` to the Chunks of each slice of dictionary batches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(1)):
                yield work(Chunks(batch, first, end, data, offsets, params), batch.column(0).slice(first, end - first), data)

    return rows


def passes(bitmap: np.ndarray, hashes: np.ndarray, params: Collocations) -> np.ndarray:
    place = hashes >> np.uint64(64 - params.filter_bits)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(keys: DataFrame, params: Collocations) -> np.ndarray:
    """Bits of the 64-bit hashes in column `key`, in at most 2**(filter_bits - 6) words."""
    place = F.shiftrightunsigned("key", 64 - params.filter_bits)
    slot, bit = F.shiftright(place, 6).alias("slot"), F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = keys.select(place.alias("place")).select(F.shiftright("place", 6).alias("slot"), bit.alias("bit"))
    held = words.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(1 << params.filter_bits - 6, np.uint64)
    found[held.column("slot").to_numpy()] = held.column("bits").to_numpy().view(np.uint64)
    return found


def _word_hash_rows(params: Collocations):
    def work(chunks: Chunks, lang: pa.Array, data: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(chunks.hashes.view(np.int64))], ["key"])

    return dictionary_rows(work, params)


def _pair_rows(shared, params: Collocations):
    """(key, times) of the owned pairs of frequent words, summed within a slice."""

    def work(chunks: Chunks, lang: pa.Array, data: np.ndarray) -> pa.RecordBatch:
        frequent = passes(np.frombuffer(shared.value, np.uint64), chunks.hashes, params)
        value, at = windows(chunks.hashes, chunks.words.row, 2)
        held = frequent[at] & frequent[at + 1] & chunks.owned[at] if len(at) else np.zeros(0, bool)
        value, times = value[held], chunks.times[chunks.words.row[at[held]]]
        order = np.argsort(value, kind="stable")
        value, times = value[order], times[order]
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
        total = np.add.reduceat(times, first) if len(first) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(value[first].view(np.int64)), pa.array(total)], ["key", "times"])

    return dictionary_rows(work, params)


def _phrase_rows(shared, params: Collocations):
    """(lang, size, phrase, times) of the owned phrases all of whose pairs passed."""

    def work(chunks: Chunks, lang: pa.Array, data: np.ndarray) -> pa.RecordBatch:
        words, n = chunks.words, len(chunks.words.begin)
        value, at = windows(chunks.hashes, words.row, 2)
        good = np.zeros(n, bool)
        good[at] = passes(np.frombuffer(shared.value, np.uint64), value, params)
        starts, sizes, held = [], [], good
        for size in range(2, params.most_words + 1):
            if size > 2:
                held = held[:-1] & good[size - 2 :]  # all pairs from the first on lie in one chunk
            begin = np.flatnonzero(held & chunks.owned[: len(held)])
            starts.append(begin)
            sizes.append(np.full(len(begin), size, np.int32))
        start, size = np.concatenate(starts), np.concatenate(sizes)
        begin, end = words.begin[start], words.end[start + size - 1]
        ends = np.zeros(len(start) + 1, np.int64)
        np.cumsum(end - begin, out=ends[1:])
        text = data[np.repeat(begin - ends[:-1], end - begin) + np.arange(ends[-1])]
        phrase = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(text)).cast(pa.string())
        row = words.row[start]
        return pa.RecordBatch.from_arrays([lang.take(pa.array(row)), pa.array(size), phrase, pa.array(chunks.times[row])], ["lang", "size", "phrase", "times"])

    return dictionary_rows(work, params)


def dictionary(docs: DataFrame, params: Collocations, lang_col: str, text_col: str) -> DataFrame:
    """(lang, chunk, last, times): the distinct chunks of each language and how often the parse holds them."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    chunks = rows.mapInArrow(chunk_rows(params), "lang string, chunk string, last boolean")
    return chunks.groupBy("lang", "chunk", "last").agg(F.count("*").alias("times"))


def phrase_counts(docs: DataFrame, params: Collocations, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (lang, phrase, f), frequent phrases (lang, size, phrase, f) and totals (lang, n)."""
    context = docs.sparkSession.sparkContext
    parsed = stored(dictionary(docs, params, lang_col, text_col), "dictionary")
    words = F.split("chunk", " ")
    owned = F.when(F.col("last"), words).otherwise(F.slice(words, F.lit(1), F.size(words) - params.overlap))
    totals = parsed.groupBy("lang").agg(F.sum(F.size(owned) * F.col("times")).alias("n"))
    single = parsed.select("lang", F.explode(owned).alias("phrase"), "times").groupBy("lang", "phrase").agg(F.sum("times").alias("f"))
    single = stored(single.where(f"f >= {params.least_count}"), "words")

    one_word = single.select("lang", "phrase", F.lit(True), F.lit(1).cast("long"))
    frequent = context.broadcast(bitmap_of(one_word.mapInArrow(_word_hash_rows(params), "key long"), params).tobytes())
    pairs = parsed.mapInArrow(_pair_rows(frequent, params), "key long, times long").groupBy("key").agg(F.sum("times").alias("f"))
    able = context.broadcast(bitmap_of(pairs.where(f"f >= {params.least_count}"), params).tobytes())
    phrases = parsed.mapInArrow(_phrase_rows(able, params), "lang string, size int, phrase string, times long")
    phrases = phrases.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("f")).where(f"f >= {params.least_count}")
    return single, stored(phrases, "phrases"), stored(totals, "totals")


def collocations(docs: DataFrame, params: Collocations = Collocations(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases.

    a, l and r count the phrase and the two parts of its lowest-scoring cut, n all words of the language, and score is floor(2000000 a / (l + r)).
    Phrases inside a longer candidate that is at least `covered_percent` as frequent are left out. Null texts are empty; a null language is `und`.
    Repeated rows count each time, other columns are ignored, and an empty table gives no rows.
    """
    single, phrases, totals = phrase_counts(docs, params, lang_col, text_col)
    whole = lambda name: F.col(name).cast("decimal(19,0)")
    counts = single.unionByName(phrases.drop("size"))
    left, right = (counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)) for side, count in (("left", "l"), ("right", "r")))
    words = F.split("phrase", " ")
    cuts = phrases.select("lang", "size", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    parts = [F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right")]
    cuts = cuts.select("lang", "phrase", "a", "k", *parts).join(left, ["lang", "left"]).join(right, ["lang", "right"])
    cuts = cuts.withColumn("sum", whole("l") + whole("r")).withColumn("product", whole("a") * F.lit(2000000).cast("decimal(7,0)"))
    cuts = cuts.select("lang", "phrase", "a", F.struct(F.expr("product div sum").alias("score"), "k", "l", "r").alias("cut"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))

    inside = phrases.where("size > 2").select("lang", "size", "phrase", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    inside = inside.select("lang", words.alias("words"), "f", "part", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("k"))
    inside = inside.select("lang", F.array_join(F.slice("words", F.col("k"), F.col("part")), " ").alias("phrase"), "f")
    covers = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    scored = scored.join(covers, ["lang", "phrase"], "left")
    scored = scored.where(F.col("longer").isNull() | (whole("longer") * 100 < whole("a") * params.covered_percent))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # A language's best are taken of a few parts of it first, so the last step sees at most salts * top rows of a language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(params.salts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= params.top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= params.top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
