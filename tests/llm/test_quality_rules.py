from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from tripmart.llm.quality_rules import COUNTS, Forest, QualityRules, calibrated, keep_good, quality_verdicts

LABELS = "doc_id long, quality int, toxic int"


def brute_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


def sample_texts(n, draw):
    rows = []
    for k in range(n):
        words = [draw.choice(["thé", "of", "andré", "ing,", "tion.", "Over"]) + str(draw.randrange(900)) for _ in range(draw.randrange(0, 120))]
        if k % 20 == 0:
            words = [word + draw.choice(["***", "$$$"]) for word in words]
        if k % 7 == 0:
            words = words[:12] * 4
        rows.append((k, "".join(word + draw.choice([" ", "\n", "\n\n", "\t"]) for word in words)))
    return rows


def test_counts_match_brute_force(spark, docs_of, odd_rows):
    rows = sample_texts(150, random.Random(8)) + [(k + 1000 if k else None, text) for k, text in odd_rows]
    found = quality_verdicts(docs_of(rows), spark.createDataFrame([], LABELS)).collect()
    assert sorted((r.doc_id or -1, *(r[name] for name in COUNTS)) for r in found) == sorted((doc or -1, *brute_counts(text)) for doc, text in rows)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels only the base rules decide


def test_verdict_follows_labels(spark, docs_of):
    rows = [(k, text) for k, text in sample_texts(600, random.Random(9)) if k % 7]
    labels = [(k, int(k % 20 != 0), 0) for k, _ in rows if k % 3] + [(None, 1, 0), (5, None, 0)]
    verdicts = {r.doc_id: r for r in quality_verdicts(docs_of(rows), spark.createDataFrame(labels, LABELS)).collect()}
    free = {k: r.kept for k, r in verdicts.items() if not r.base_failed}
    good, bad = [kept for k, kept in free.items() if k % 20], [kept for k, kept in free.items() if k % 20 == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.3


def test_forest_isolates_outliers():
    draw = np.random.default_rng(1)
    sample = draw.normal(0, 1, (2000, 3))
    forest = Forest(sample, QualityRules())
    assert forest.score(np.array([[8.0, 8.0, 8.0]]))[0] > forest.score(sample).max() - 0.05
    assert np.isclose(forest.average_path(2), 1) and forest.average_path(1) == 0


def test_calibration():
    assert calibrated({(400, 1): 990, (700, 1): 10, (800, 0): 50, (300, 0): 50}, 0.01) <= 0.8
    assert calibrated({(400, 1): 10}, 0.01) == 2.0 and calibrated({}, 0.01) == 2.0


def test_stage_keeps_columns_and_rows_without_id(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = keep_good(docs, spark.createDataFrame([], LABELS))
    assert kept.columns == docs.columns
    assert [str(r.doc_id) for r in kept.collect()].count("None") == 1
    assert quality_verdicts(docs_of([]), spark.createDataFrame([], LABELS)).collect() == []
