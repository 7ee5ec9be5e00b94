"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a vector of counts: classes of three neighbouring characters (letters by case, digits, white space, marks,
symbols, other scripts), hashed words, and words that repeat one shortly before. Counts are damped and weighted by inverse document frequency over all
documents given to `learn` (the query gives those that are not held out); a truncated singular value decomposition of a bounded labelled sample gives the latent space. The sample's
latent vectors (at most `neighbours_from` rows of `rank` numbers) are broadcast. Every document's cosines with all of them are
computed exactly, in blocks, and its `k` nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import bounded_rows, stored
from tripmart.llm.textops import SPACE, Words, slices

CLASSES = 8
_CLASS = np.full(256, 7, np.int64)  # marks and other ASCII
_CLASS[SPACE] = 0
_CLASS[10] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[list(b"#*$%&|<>")] = 5
_CLASS[list(b".,;:'")] = 6
_CLASS[0x80:] = 2
SHAPES = CLASSES**3
REPEATS = 4  # words equal to the one so many words before, and all words


@dataclass(frozen=True)
class QualityKnn:
    words: int = 512
    rank: int = 48
    neighbours_from: int = 6000
    k: int = 25
    power: float = 4.0

    @property
    def width(self) -> int:
        return SHAPES + self.words + REPEATS


def features(data: np.ndarray, offsets: np.ndarray, params: QualityKnn) -> np.ndarray:
    """Damped counts of character shapes and hashed words, each part relative to the text's length."""
    rows = len(offsets) - 1
    counts = np.zeros((rows, params.width), np.float32)
    if not len(data):
        return counts
    kind = _CLASS[data]
    shape = kind[:-2] * CLASSES**2 + kind[1:-1] * CLASSES + kind[2:] if len(data) > 2 else kind[:0]
    row = np.repeat(np.arange(rows), np.diff(offsets))
    inside = np.flatnonzero(row[: len(shape)] == row[2:]) if len(data) > 2 else np.zeros(0, np.int64)
    counts[:, :SHAPES] = np.bincount(row[inside] * SHAPES + shape[inside], minlength=rows * SHAPES).reshape(rows, SHAPES)
    words = Words(data, offsets)
    hashes = words.hashes(lower=True)
    for step in range(1, REPEATS):
        same = np.flatnonzero((hashes[step:] == hashes[:-step]) & (words.row[step:] == words.row[:-step]))
        counts[:, SHAPES + params.words + step - 1] = np.bincount(words.row[same], minlength=rows)
    counts[:, -1] = np.diff(words.first)
    bucket = (hashes % np.uint64(params.words)).astype(np.int64)
    counts[:, SHAPES : SHAPES + params.words] = np.bincount(words.row * params.words + bucket, minlength=rows * params.words).reshape(rows, params.words)
    for first, last in ((0, SHAPES), (SHAPES, SHAPES + params.words), (SHAPES + params.words, params.width)):
        part = counts[:, first:last]
        part *= 1000 / np.maximum(part.sum(1, keepdims=True), 1)
    return np.log1p(counts)


def _frequency_rows(params: QualityKnn):
    """text to (feature, docs): how many texts have each feature; feature -1 counts the texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(params.width, np.int64), 0
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(0)):
                seen += (features(data, offsets, params) > 0).sum(0)
                texts += last - first
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(params.width)], pa.int32()), pa.array([texts, *seen.tolist()], pa.int64())], ["feature", "docs"])

    return rows


@dataclass
class KnnModel:
    """Inverse document frequencies, the projection to the latent space, and the labelled unit vectors."""

    params: QualityKnn
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    share: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors; zero for texts without features."""
        found = (counts * self.idf) @ self.projection
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray, block: int = 512) -> np.ndarray:
        """Similarity-weighted share of good neighbours; the overall share where no neighbour is similar."""
        found = np.empty(len(counts))
        k = min(self.params.k, len(self.vectors))
        for first in range(0, len(counts), block):
            cosine = self.latent(counts[first : first + block]) @ self.vectors.T
            nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, nearest, 1), 0) ** self.params.power
            # One neighbour's worth of the overall share keeps the vote defined, and decides where nothing is similar.
            prior = 1e-3
            found[first : first + block] = ((weight * self.good[nearest]).sum(1) + prior * self.share) / (weight.sum(1) + prior)
        return found


def learn(docs: DataFrame, labels: DataFrame, params: QualityKnn = QualityKnn()) -> KnnModel | None:
    """A model from docs (doc_id, text) and labels (doc_id, quality); pass only rows that may be learned from. None without labelled rows.

    Frequencies are counted over all of docs. The labelled sample holds at most half of `neighbours_from` rows of each
    label, chosen by a hash of the id, and a text once; an id labelled twice counts as good if any label says so.
    """
    seen = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequency_rows(params), "feature int, docs long")
    total, frequency = 0, np.zeros(params.width)
    for row in seen.groupBy("feature").agg(F.sum("docs").alias("docs")).collect():
        if row["feature"] < 0:
            total = row["docs"]
        else:
            frequency[row["feature"]] = row["docs"]
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") > 0).cast("int")).alias("good"))
    ids = stored(docs.select("doc_id").join(known, "doc_id"), "labelled")
    chosen = bounded_rows(ids.where("good = 0"), "doc_id", params.neighbours_from // 2).unionByName(bounded_rows(ids.where("good = 1"), "doc_id", params.neighbours_from // 2))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(2)):
                found = features(data, offsets, params).astype(np.float16)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(first, last - first) for k in (0, 1)), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "good", "counts"])

    sample = rows.select("doc_id", "good", "text").mapInArrow(vector_rows, "doc_id long, good int, counts binary").toPandas()
    if not len(sample):
        return None
    sample = sample.sort_values(["doc_id", "counts"]).drop_duplicates("counts")
    counts = np.stack([np.frombuffer(x, np.float16) for x in sample["counts"]]).astype(np.float32)
    good = sample["good"].to_numpy(float)
    idf = np.log((1 + total) / (1 + frequency)) + 0.1
    weighted = counts * idf.astype(np.float32)
    # Right singular vectors from the Gram matrix, whose size does not depend on the sample.
    values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    projection = vectors[:, np.argsort(-values)[: params.rank]].astype(np.float32)
    model = KnnModel(params, idf.astype(np.float32), projection, np.zeros((0, params.rank), np.float32), good, float(good.mean()))
    model.vectors = model.latent(counts).astype(np.float32)
    return model


def score(docs: DataFrame, model: KnnModel | None) -> DataFrame:
    """(doc_id, score) for every row of docs: the weighted share of good neighbours, from 0 to 1.

    Null and empty texts are similar to nothing and get the sample's share of good rows; without a model every score is 0.5. Rows are scored
    one by one: repeated rows and null ids need no rule, other columns are ignored, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                model = shared.value
                found = model.score(features(data, offsets, model.params)) if model else np.full(last - first, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(found.astype(np.float64))], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def predicted(column: str = "score") -> Column:
    return (F.col(column) >= 0.5).cast("int").alias("predicted")
