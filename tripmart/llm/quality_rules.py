"""Quality rules: base counts of every text, and an isolation forest over rule statistics as the verdict.

The forest is grown on a bounded sample of documents (`trees * sample_rows` at most); its path lengths over random
splits give every document an anomaly score. The threshold on that score comes from labelled rows:
the one with the best balanced accuracy among those that reject at most `most_good_rejected` of the good rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import bounded_rows, settled, stored
from tripmart.llm.textops import SPACE, Words, mix, slices, windows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("word_length", "symbols_per_word", "bare_word_share", "duplicate_line_share", "repeated_word_share", "upper_share")
WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LOWER[97:123] = True
_DIGIT[48:58] = True
_LINE_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_LINE_VALUES[10] = 0
SCORE_BINS = 1000


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 20
    most_repeated_percent: int = 30
    trees: int = 100
    sample_rows: int = 256
    most_good_rejected: float = 0.005
    seed: int = 5


def _line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every line that holds a word; equal hashes mean equal lines."""
    breaks = np.flatnonzero(data == 10) + 1
    begin = np.unique(np.concatenate([offsets[:-1], breaks]))
    begin = begin[begin < len(data)]
    # Horner's rule over blocks of a line would need a loop; position-weighted sums with a per-line correction do not.
    steps = np.full(len(data), 0xD1342543DE82EF95, np.uint64)
    steps[0] = 1
    power = np.cumprod(steps, dtype=np.uint64)
    back = np.full(len(data), pow(0xD1342543DE82EF95, -1, 1 << 64), np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    value = np.add.reduceat(_LINE_VALUES[data] * power, begin) * back[begin]
    held = np.add.reduceat(~SPACE[data], begin, dtype=np.int64) > 0
    row = np.searchsorted(offsets, begin, "right") - 1
    return row[held], mix(value[held])


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags between each two offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def count_rows(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of COUNTS and further ones for each text of a slice."""
    rows = len(offsets) - 1
    if not len(data):
        zero = np.zeros(rows, np.int64)
        return {name: zero for name in (*COUNTS, "lines", "upper", "lower", "bare")}
    words = Words(data, offsets)
    inside = ~SPACE[data]
    lead = (data & 0xC0) != 0x80
    found = {
        "n_words": np.diff(words.first),
        "word_chars": _per_row(inside & lead, offsets),
        "n_symbols": _per_row(_SYMBOLS[data], offsets),
        "upper": _per_row(_UPPER[data], offsets),
        "lower": _per_row(_LOWER[data], offsets),
    }
    row, value = _line_hashes(data, offsets)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    again = np.zeros(len(row), bool)
    again[1:] = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    found["n_dup_lines"] = np.bincount(row[again], minlength=rows)
    found["lines"] = np.bincount(row, minlength=rows)
    # A word without any letter, digit or byte beyond ASCII.
    text = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data] | _LOWER[data] | _DIGIT[data] | (data >= 0x80), out=text[1:])
    bare = text[words.end] == text[words.begin]
    found["bare"] = np.bincount(words.row[bare], minlength=rows)

    value, at = windows(words.hashes(), words.row, WINDOW)
    value = value ^ mix(words.row[at].astype(np.uint64))
    order = np.argsort(value)
    ordered = value[order]
    equal = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(value), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    at = at[order[twice]]
    change = np.zeros(len(words.begin) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    found["n_repeat_words"] = np.bincount(words.row[np.cumsum(change[:-1]) > 0], minlength=rows)
    return found


def rule_values(found: dict[str, np.ndarray]) -> np.ndarray:
    """One row of RULES for each text."""

    def drawn(part: str, whole: np.ndarray, usual: float, weight: float) -> np.ndarray:
        """A ratio drawn to its usual value as by `weight` more units, so that short texts are not odd by chance."""
        return (found[part] + weight * usual) / (whole + weight)

    return np.stack(
        [
            drawn("word_chars", found["n_words"], 6.0, 20),
            drawn("n_symbols", found["n_words"], 0.0, 20),
            drawn("bare", found["n_words"], 0.0, 20),
            drawn("n_dup_lines", found["lines"], 0.0, 3),
            drawn("n_repeat_words", found["n_words"], 0.0, 20),
            drawn("upper", found["upper"] + found["lower"], 0.03, 100),
        ],
        axis=1,
    )


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(1)):
            found = count_rows(data, offsets)
            values = rule_values(found)
            columns = [batch.column(0).slice(first, last - first)]
            columns += [pa.array(found[name].astype(np.int64)) for name in COUNTS]
            columns += [pa.array(np.ascontiguousarray(values[:, k])) for k in range(len(RULES))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, *RULES])


STATISTICS_SCHEMA = ", ".join(["doc_id long", *(f"{name} long" for name in COUNTS), *(f"{name} double" for name in RULES)])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(_statistics_rows, STATISTICS_SCHEMA)


class Forest:
    """Isolation trees in flat arrays: feature, threshold, children, and the path length credited at a leaf."""

    def __init__(self, sample: np.ndarray, params: QualityRules):
        draw = np.random.default_rng(params.seed)
        self.size = min(params.sample_rows, len(sample))
        depth = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        self.depth, self.trees = depth, []
        for _ in range(params.trees):
            rows = sample[draw.choice(len(sample), self.size, replace=False)]
            self.trees.append(self._grow(rows, depth, draw))

    @staticmethod
    def average_path(n) -> np.ndarray:
        """Mean path length of an unsuccessful search in a binary tree of n leaves."""
        n = np.asarray(n, float)
        more = np.maximum(n, 2)
        return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(more - 1) + 0.5772156649015329) - 2 * (more - 1) / more))

    def _grow(self, rows: np.ndarray, depth: int, draw) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, path = [], [], [], [], []

        def node(part: np.ndarray, level: int) -> int:
            here = len(feature)
            feature.append(0), cut.append(np.inf), left.append(here), right.append(here)
            path.append(level + float(self.average_path(len(part))))
            low, high = part.min(0), part.max(0)
            able = np.flatnonzero(high > low)
            if level < depth and len(part) > 1 and len(able):
                feature[here] = int(draw.choice(able))
                cut[here] = float(draw.uniform(low[feature[here]], high[feature[here]]))
                below = part[:, feature[here]] < cut[here]
                if below.any() and not below.all():
                    left[here] = node(part[below], level + 1)
                    right[here] = node(part[~below], level + 1)
                else:
                    cut[here] = np.inf
            return here

        node(rows, 0)
        return tuple(np.array(x) for x in (feature, cut, left, right, path))

    def score(self, values: np.ndarray) -> np.ndarray:
        """Anomaly of each row, from 0 to 1; higher is stranger."""
        total = np.zeros(len(values))
        every = np.arange(len(values))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(values), np.int64)
            for _ in range(self.depth):
                at = np.where(values[every, feature[at]] < cut[at], left[at], right[at])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(self.average_path(self.size)), 1e-9))


def calibrated(bins: dict[tuple[int, int], int], most_good_rejected: float) -> float:
    """Lowest score that is rejected, from counts by (score bin, quality); above 1 where labels can't tell."""
    good = np.zeros(SCORE_BINS + 1)
    bad = np.zeros(SCORE_BINS + 1)
    for (score, quality), n in bins.items():
        (good if quality else bad)[score] += n
    if not good.sum() or not bad.sum():
        return 2.0
    lost = np.cumsum(good[::-1])[::-1] / good.sum()
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= most_good_rejected, caught - lost, -1)
    best = int(np.argmax(gain))
    return best / SCORE_BINS if gain[best] > 0 else 2.0


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, params: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, counts of COUNTS, base_failed, kept, anomaly) for every row of docs.

    Null and blank texts have no words and so fail the base rules. Rows without id are judged like others but can't be
    matched to labels. Labels without quality are ignored; an id labelled twice counts with each label. Without usable labels, or with fewer
    than two documents, only the base rules decide. An empty table gives no rows.
    """
    spark = docs.sparkSession
    found = stored(statistics(docs, id_col, text_col), "statistics")
    base_failed = (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.most_repeated_percent * F.col("n_words"))
    sample = bounded_rows(found.where("doc_id is not null"), "doc_id", params.trees * params.sample_rows).select(*RULES)
    rows = np.array([tuple(row) for row in sample.collect()], float).reshape(-1, len(RULES))
    if len(rows) < 2:
        return found.select("doc_id", *COUNTS, base_failed.alias("base_failed"), (~base_failed).alias("kept"), F.lit(0.0).alias("anomaly"))
    forest = spark.sparkContext.broadcast(Forest(rows, params))

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(1 + len(COUNTS) + k).to_numpy() for k in range(len(RULES))], axis=1)
            score = forest.value.score(values) if len(values) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: 1 + len(COUNTS)], pa.array(score)], ["doc_id", *COUNTS, "anomaly"])

    schema = ", ".join(["doc_id long", *(f"{name} long" for name in COUNTS), "anomaly double"])
    scored = stored(found.mapInArrow(score_rows, schema), "anomaly")
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    bins = scored.where(~base_failed).join(known, "doc_id").groupBy(F.floor(F.col("anomaly") * SCORE_BINS).cast("int").alias("score"), (F.col("quality") > 0).cast("int").alias("quality")).count()
    threshold = calibrated({(row["score"], row["quality"]): row["count"] for row in bins.collect()}, params.most_good_rejected)
    kept = ~base_failed & (F.floor(F.col("anomaly") * SCORE_BINS) < round(threshold * SCORE_BINS))
    return scored.select("doc_id", *COUNTS, base_failed.alias("base_failed"), kept.alias("kept"), "anomaly")


def keep_good(docs: DataFrame, labels: DataFrame, params: QualityRules = QualityRules()) -> DataFrame:
    """The documents that are not rejected; columns as they were. Rows without id stay."""
    found = lambda: quality_verdicts(docs, labels, params).where("not kept and doc_id is not null").select("doc_id").distinct()
    rejected = settled(docs.sparkSession, found, "rejected")
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)
