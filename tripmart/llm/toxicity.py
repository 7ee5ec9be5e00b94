"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

Voters are word lists and patterns: fixed insults, the same in digits-for-letters spelling, insults next to a second-person word, shouting,
runs of exclamation marks, and words and word beginnings that mark the toxic rows among the labelled ones. The label model estimates by EM
each voter's accuracy in both classes and the correlations of voters within a class; correlated voters share their
weight. It works on counts of vote patterns (at most 2**voters rows), so it sees all documents given to `learn` at any scale (the query
gives those that are not held out); labelled rows enter with
their label known. A logistic regression on marking words, beginnings and votes is then fitted to the
posteriors of a bounded sample, labelled rows like all others.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import bounded_rows, stored
from tripmart.llm.textops import SPACE, Words, mix, slices, windows

SEPARATORS = SPACE.copy()
SEPARATORS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
SPELLING = SEPARATORS.copy()
SPELLING[list(b"@$")] = False
INSULTS = (
    "idiot idiots moron morons imbecile scum loser losers stupid dumb worthless pathetic trash garbage clown disgusting filth vermin bastard bitch asshole "
    "idiota imbécil estúpido estúpida basura escoria inútil asqueroso imbécile connard salope ordure crétin abruti pourriture "
    "dumm idioten dummkopf trottel arschloch abschaum versager widerlich dreckig hurensohn"
).split()
SECOND_PERSON = "you your youre u ur tu vous toi vos usted ustedes vosotros te du dich dir ihr euch".split()
VOTERS = ("insult", "insults", "disguised", "shouting", "exclaiming", "addressed", "words_a", "words_b", "beginnings", "marked_twice", "begun_twice", "begun_often")
BEGINNINGS = (4, 5, 6, 7)  # bytes of a longer word
_LEET = np.arange(256, dtype=np.uint8)
for _from, _to in zip(b"013457@$", b"oieastas"):
    _LEET[_from] = _to


@dataclass(frozen=True)
class Toxicity:
    buckets: int = 1 << 18
    marking_words: int = 1024
    min_toxic_rows: int = 4
    marking_ratio: float = 4.0
    marking_strength: float = 4.0
    sample_rows: int = 30_000
    labelled_rows: int = 40_000
    em_steps: int = 30
    fit_steps: int = 400
    ridge: float = 1e-3


def hashed_words(texts: list[str]) -> np.ndarray:
    data = pa.array(["\n".join(texts)])
    _, _, raw, offsets = next(slices(data))
    return np.unique(Words(raw, offsets, SEPARATORS).hashes(lower=True))


class TextWords:
    """Hashes of the words and word beginnings of a slice, and what the pattern voters look at."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.words = Words(data, offsets, SEPARATORS)
        self.hashes = self.words.hashes(lower=True)
        self.row = self.words.row
        owners, values, numbers = [], [], []
        for size in BEGINNINGS:
            long = np.flatnonzero(self.words.end - self.words.begin > size)
            head = data[self.words.begin[long][:, None] + np.arange(size)].astype(np.uint64)
            head |= np.uint64(0x20) * ((head >= 65) & (head <= 90))
            packed = (head << (np.arange(size, dtype=np.uint64) * np.uint64(8))).sum(1, dtype=np.uint64)
            owners.append(self.row[long])
            numbers.append(long)
            values.append(mix(packed ^ np.uint64(0x1D8E4E27C47D124F * size & (1 << 64) - 1)))
        self.begin_row, self.begin_hashes, self.begin_word = np.concatenate(owners), np.concatenate(values), np.concatenate(numbers)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of all words and beginnings, with repeats."""
        return np.concatenate([self.row, self.begin_row]), np.concatenate([self.hashes, self.begin_hashes])


class HashSet:
    """Place of 64-bit hashes in a sorted array, -1 for those that are not in it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.mark: np.ndarray | None = None

    def __getstate__(self) -> dict:
        # Every task of a job keeps a copy of what is broadcast on disk, so only the values travel.
        return {"values": self.values, "mark": None}

    def place(self, hashes: np.ndarray) -> np.ndarray:
        if self.mark is None:
            self.mark = np.zeros(1 << 20, bool)
            self.mark[self.values >> np.uint64(44)] = True
        found = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.mark[hashes >> np.uint64(44)])
        at = np.searchsorted(self.values, hashes[maybe])
        same = self.values[np.minimum(at, len(self.values) - 1)] == hashes[maybe] if len(self.values) else np.zeros(0, bool)
        found[maybe[same]] = at[same]
        return found


class Voters:
    """Votes as one bit each, and the marking words and beginnings of a text (sorted hashes; which of them are toxic)."""

    def __init__(self, marking: np.ndarray, toxic_side: np.ndarray, params: Toxicity):
        self.params = params
        self.insults, self.second = hashed_words(INSULTS), hashed_words(SECOND_PERSON)
        self.marking = HashSet(marking)
        self.toxic_side = toxic_side
        self.n_features = len(marking) + len(VOTERS) + 1

    def look(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vote bits of each row, row and marking number of each distinct marking bucket)."""
        rows = len(offsets) - 1
        text = TextWords(data, offsets)
        per_row = lambda held: np.bincount(text.row[held], minlength=rows)
        insult = np.isin(text.hashes, self.insults)
        spelled = Words(_LEET[data], offsets, SPELLING)
        changed = _LEET[data] != data
        moved = np.zeros(len(data) + 1, np.int64)
        np.cumsum(changed, out=moved[1:])
        odd = np.flatnonzero(moved[spelled.end] > moved[spelled.begin]) if len(spelled.begin) else np.zeros(0, np.int64)
        disguised = odd[np.isin(spelled.hashes(lower=True)[odd], self.insults)] if len(odd) else odd
        word_mark = self.marking.place(text.hashes)
        begin_mark = self.marking.place(text.begin_hashes)
        toxic_word = (word_mark >= 0) & self.toxic_side[word_mark] if len(self.toxic_side) else np.zeros(len(word_mark), bool)
        toxic_begin = (begin_mark >= 0) & self.toxic_side[begin_mark] if len(self.toxic_side) else np.zeros(len(begin_mark), bool)
        bad = insult | toxic_word
        second = np.flatnonzero(np.isin(text.hashes, self.second))
        near = np.zeros(len(bad), bool)
        for step in (-2, -1, 1, 2):
            other = second[(second + step >= 0) & (second + step < len(bad))]
            same = text.row[other] == text.row[other + step]
            near[other[same]] |= bad[other[same] + step]
        total = np.zeros((4, len(data) + 1), np.int64)
        upper = (data >= 65) & (data <= 90)
        mark = data == 33
        runs = mark.copy()
        runs[1:] &= mark[:-1]
        runs[:1] = False
        for k, flags in enumerate((upper, (data >= 97) & (data <= 122), mark, runs)):
            np.cumsum(flags, out=total[k, 1:])
        ups, lows, _, bangs = np.diff(total[:, offsets], axis=1)
        half = (text.hashes >> np.uint64(40)) & np.uint64(1) == 1
        begun = np.bincount(text.row[np.unique(text.begin_word[toxic_begin])], minlength=rows)
        votes = [
            per_row(insult) > 0,
            per_row(insult) > 1,
            np.bincount(spelled.row[disguised], minlength=rows) > 0,
            (ups + lows >= 20) & (ups > 0.6 * (ups + lows)),
            bangs >= 2,
            per_row(near) > 0,
            per_row(toxic_word & half) > 0,
            per_row(toxic_word & ~half) > 0,
            begun > 0,
            per_row(toxic_word) > 1,
            begun > 1,
            begun > 3,
        ]
        bits = sum(np.asarray(vote, np.int64) << k for k, vote in enumerate(votes))
        owner = np.concatenate([text.row[word_mark >= 0], text.begin_row[begin_mark >= 0]])
        number = np.concatenate([word_mark[word_mark >= 0], begin_mark[begin_mark >= 0]]).astype(np.int64)
        pairs = np.unique(owner * self.n_features + number)
        return bits, pairs // self.n_features, pairs % self.n_features


class LabelModel:
    """Class prior, voter accuracies and correlations from counts of vote patterns, some with a known label."""

    def __init__(self, patterns: list[tuple[int, int, int]], params: Toxicity):
        bits = np.array([p[0] for p in patterns], np.int64)
        known = np.array([p[1] for p in patterns], np.int64)  # 1, 0, or -1 for unknown
        count = np.array([p[2] for p in patterns], float)
        votes = (bits[:, None] >> np.arange(len(VOTERS))) & 1
        self.rate = np.stack([np.full(len(VOTERS), 0.02), np.full(len(VOTERS), 0.5)])
        self.share = np.ones(len(VOTERS))
        self.prior = 0.1
        self.correlation = np.zeros((2, len(VOTERS), len(VOTERS)))
        for _ in range(params.em_steps):
            toxic = np.where(known >= 0, known, self.posterior(bits))
            for label, weight in enumerate((count * (1 - toxic), count * toxic)):
                self.rate[label] = (weight @ votes + 0.5) / (weight.sum() + 1)
                deviation = votes - self.rate[label]
                covariance = (deviation * weight[:, None]).T @ deviation / (weight.sum() + 1)
                scale = np.sqrt(self.rate[label] * (1 - self.rate[label]))
                self.correlation[label] = covariance / np.outer(scale, scale)
            self.prior = float((count @ toxic + 0.5) / (count.sum() + 1))
            shared = np.clip(self.correlation.max(0), 0, 1)
            np.fill_diagonal(shared, 0)
            self.share = 1 / (1 + shared.sum(0))

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        votes = (np.asarray(bits)[:, None] >> np.arange(len(VOTERS))) & 1
        gain = np.where(votes, np.log(self.rate[1] / self.rate[0]), np.log((1 - self.rate[1]) / (1 - self.rate[0])))
        logit = np.log(self.prior / (1 - self.prior)) + gain @ self.share
        return 1 / (1 + np.exp(-logit))


def fit_linear(rows: list[np.ndarray], target: np.ndarray, stands_for: np.ndarray, n: int, params: Toxicity) -> np.ndarray:
    """Weights of a logistic regression over sparse 0/1 features, by Adam on the whole sample; each row counts as many times as rows it stands for."""
    share = stands_for / stands_for.sum()
    owner = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    column = np.concatenate(rows)
    weights, mean, square = np.zeros(n), np.zeros(n), np.zeros(n)
    for step in range(1, params.fit_steps + 1):
        logit = np.bincount(owner, weights[column], len(rows))
        error = (1 / (1 + np.exp(-logit)) - target) * share
        gradient = np.bincount(column, error[owner], n) + params.ridge / len(rows) * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return weights


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, text) to (doc_id, label, one, two): two MinHash values of the text's three-word shingles, or of a shorter text as a whole."""
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(2)):
            words = Words(data, offsets, SEPARATORS)
            hashes = words.hashes(lower=True)
            value, at = windows(hashes, words.row, 3)
            row = words.row[at]
            own, begin = np.unique(row, return_index=True)
            least = np.zeros((2, last - first), np.int64)
            count = np.diff(words.first)
            short = np.flatnonzero((count > 0) & (count < 3))
            least[:, short] = mix(mix(hashes[words.first[short]]) ^ hashes[words.first[short + 1] - 1] ^ count[short].astype(np.uint64)).view(np.int64)
            for k in (0, 1):
                if len(own):
                    least[k, own] = np.minimum.reduceat(mix(value ^ np.uint64(k + 1)), begin).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(first, last - first) for k in (0, 1)), pa.array(least[0]), pa.array(least[1])], ["doc_id", "label", "one", "two"])


def unlike_rows(seen: DataFrame) -> DataFrame:
    """(label, text) of labelled rows (doc_id, label, text), one of each group of like texts, those that agree in two MinHash values.

    The rows given are a bounded sample, so the ids left of them are broadcast.

    Copies would otherwise make every word of a much copied text look like a mark of its label.
    """
    sketches = seen.mapInArrow(_sketch_rows, "doc_id long, label int, one long, two long")
    ids = stored(sketches.groupBy("label", "one", "two").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "unlike")
    return seen.join(F.broadcast(ids), "doc_id").select("label", "text")


def _bucket_rows(params: Toxicity):
    """(label, text) to (bucket, toxic, clean): texts of each label that have a word or beginning of the bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, params.buckets), np.int64)
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last, data, offsets in slices(batch.column(1)):
                row, value = TextWords(data, offsets).features()
                pairs = np.unique(row * params.buckets + (value % np.uint64(params.buckets)).astype(np.int64))
                bucket, own = pairs % params.buckets, label[first + pairs // params.buckets]
                for k in (0, 1):
                    counts[k] += np.bincount(bucket[own == k], minlength=params.buckets)
        held = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[1, held]), pa.array(counts[0, held])], ["value", "toxic", "clean"])

    return rows


def _hash_rows(buckets: np.ndarray, params: Toxicity):
    """(label, text) to (value, toxic, clean) of the single words and beginnings in the given buckets."""
    wanted = np.zeros(params.buckets, bool)
    wanted[buckets] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last, data, offsets in slices(batch.column(1)):
                row, value = TextWords(data, offsets).features()
                held = wanted[(value % np.uint64(params.buckets)).astype(np.int64)]
                values, number = np.unique(value[held], return_inverse=True)
                pairs = np.unique(row[held] * max(len(values), 1) + number)
                own, number = label[first + pairs // max(len(values), 1)], pairs % max(len(values), 1)
                counts = [np.bincount(number[own == k], minlength=len(values)) for k in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), *(pa.array(n.astype(np.int64)) for n in counts)], ["value", "toxic", "clean"])

    return rows


def _strength(toxic: np.ndarray, clean: np.ndarray, size: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """How many standard errors apart the rates in toxic and clean rows are, and their ratio."""
    rate = [(n + 0.5) / (size.get(k, 0) + 1) for k, n in ((0, clean), (1, toxic))]
    spread = np.sqrt(rate[1] / (size.get(1, 0) + 1) + rate[0] / (size.get(0, 0) + 1))
    return (rate[1] - rate[0]) / spread, rate[1] / rate[0]


def marking_words(seen: DataFrame, size: dict[int, int], params: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and beginnings that set toxic rows apart, sorted, and which stand on the toxic side.

    Buckets of hashes are counted first, in a bounded table; only words of buckets that differ between the labels are counted one by one.
    """

    def counted(rows) -> list[np.ndarray]:
        found = [(row["value"], row["toxic"], row["clean"]) for row in rows]
        return list(np.array(found, np.int64).reshape(-1, 3).T)

    total = [F.sum(name).alias(name) for name in ("toxic", "clean")]
    schema = "value long, toxic long, clean long"
    buckets, toxic, clean = counted(seen.mapInArrow(_bucket_rows(params), schema).groupBy("value").agg(*total).toLocalIterator())
    strength, _ = _strength(toxic, clean, size)
    order = np.argsort(-np.abs(strength), kind="stable")
    held = buckets[order[np.abs(strength[order]) >= params.marking_strength / 2][: 16 * params.marking_words]]
    single = seen.mapInArrow(_hash_rows(held, params), schema).groupBy("value").agg(*total).where(f"toxic >= {params.min_toxic_rows} or clean >= {params.min_toxic_rows}")
    # Only the strongest leave Spark; the order is the same formula.
    rate = lambda n, k: (F.col(n) + 0.5) / (size.get(k, 0) + 1)
    power = (rate("toxic", 1) - rate("clean", 0)) / F.sqrt(rate("toxic", 1) / (size.get(1, 0) + 1) + rate("clean", 0) / (size.get(0, 0) + 1))
    single = stored(single.withColumn("power", power), "marking")
    best = [single.orderBy(F.desc("power"), "value").limit(params.marking_words), single.orderBy("power", "value").limit(params.marking_words // 4)]
    values, toxic, clean = counted([row for part in best for row in part.collect()])
    strength, ratio = _strength(toxic, clean, size)
    side = (strength >= params.marking_strength) & (ratio >= params.marking_ratio)
    use = side | ((strength <= -params.marking_strength) & (ratio <= 1 / params.marking_ratio))
    hashes, first = np.unique(values[use].view(np.uint64), return_index=True)
    return hashes, side[use][first]


def _vote_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters: Voters = pickle.loads(shared.value)
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(2)):
                bits, row, number = voters.look(data, offsets)
                ends = np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32)
                features = pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(first, last - first) for k in (0, 1)), pa.array(bits.astype(np.int32)), features], ["doc_id", "label", "bits", "features"])

    return rows


@dataclass
class ToxicityModel:
    voters: Voters
    label_model: LabelModel
    weights: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        bits, row, number = self.voters.look(data, offsets)
        marks = self.voters.n_features - len(VOTERS) - 1
        votes = (bits[:, None] >> np.arange(len(VOTERS))) & 1
        logit = np.bincount(row, self.weights[number], rows) + votes @ self.weights[marks:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-logit))


def learn(docs: DataFrame, labels: DataFrame, params: Toxicity = Toxicity()) -> ToxicityModel | None:
    """A model from docs (text, doc_id) and labels (doc_id, toxic); pass only rows that may be learned from. None without documents.

    At most half of `labelled_rows` labels of each kind are used, chosen by a hash of the id. They are broadcast, so no text moves;
    the label model counts the vote patterns of all documents, those beyond the bound without their label. An id
    labelled twice is toxic if any label says so.
    """
    spark = docs.sparkSession
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    known = stored(known, "labels")
    halves = [bounded_rows(known.where(f"label = {k}"), "doc_id", params.labelled_rows // 2) for k in (0, 1)]
    chosen = F.broadcast(stored(halves[0].unionByName(halves[1]), "labelled"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null").join(chosen, "doc_id", "left")
    seen = unlike_rows(rows.where("label is not null").select("doc_id", "label", "text"))
    size = {row["label"]: row["count"] for row in seen.groupBy("label").count().collect()}
    marking, toxic_side = marking_words(seen, size, params) if size.get(1) and size.get(0) else (np.zeros(0, np.uint64), np.zeros(0, bool))
    voters = Voters(marking, toxic_side, params)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(voters))
    voted = rows.select("doc_id", F.coalesce("label", F.lit(-1)).cast("int").alias("label"), "text")
    voted = stored(voted.mapInArrow(_vote_rows(shared), "doc_id long, label int, bits int, features array<int>"), "votes")
    patterns = [(row["bits"], row["label"], row["count"]) for row in voted.groupBy("bits", "label").count().collect()]
    if not patterns:
        return None
    model = LabelModel(sorted(patterns), params)
    # Half of the sample has votes and half has none; each row stands for its part of the rows of its half.
    sample, stands_for = [], []
    for part, rows_of in (("bits > 0", [n for bits, _, n in patterns if bits]), ("bits = 0", [n for bits, _, n in patterns if not bits])):
        chosen_rows = bounded_rows(voted.where(part), "doc_id", params.sample_rows // 2).collect()
        sample += chosen_rows
        stands_for += [sum(rows_of) / max(len(chosen_rows), 1)] * len(chosen_rows)
    bits = np.array([row["bits"] for row in sample], np.int64)
    target = model.posterior(bits)
    marks, features = len(marking), []
    for row, own in zip(sample, bits.tolist()):
        votes = [marks + k for k in range(len(VOTERS)) if own >> k & 1]
        features.append(np.array([*row["features"], *votes, marks + len(VOTERS)], np.int64))
    return ToxicityModel(voters, model, fit_linear(features, target, np.array(stands_for), voters.n_features, params))


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """(doc_id, score) for every row of docs.

    Null and blank texts have no votes and no words, and get the score of the intercept. Without a model every score is 0. Rows are scored
    one by one: repeated rows and null ids need no rule, other columns are ignored, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel | None = pickle.loads(shared.value)
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                found = model.score(data, offsets) if model else np.zeros(last - first)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(found)], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def predicted(column: str = "score") -> Column:
    return (F.col(column) >= 0.5).cast("int").alias("predicted")
