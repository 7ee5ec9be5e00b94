from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tripmart.llm import quality_knn, toxicity
from tripmart.llm.queries import QUERIES
from tripmart.llm.textops import slices

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.01"


def prose(draw, words=60):
    return " ".join("".join(draw.choices(["tha", "in", "er", "on", "st"], k=3)) for _ in range(words))


def separated(rows):
    """Share of (positive, negative) pairs in the right order."""
    good = [score for label, score in rows if label]
    bad = [score for label, score in rows if not label]
    return np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])


def held_out_scores(spark, name, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES[name](spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    return [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]


def test_held_out_quality(spark):
    assert separated(held_out_scores(spark, "op6_quality_classifier", "quality")) > 0.97


def test_held_out_toxicity(spark):
    assert separated(held_out_scores(spark, "op1_toxicity", "toxic")) > 0.8


def test_toxic_words_are_learned(spark, docs_of):
    draw = random.Random(3)
    rows = [(k, prose(draw) + (" you grumblefark " + prose(draw, 10) if k % 4 == 0 else "")) for k in range(400)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(0, 300)], LABELS)
    model = toxicity.learn(docs_of(rows), labels)
    probe = [(1, "well, Grumblefark! " + prose(draw)), (2, prose(draw)), (3, None), (4, ""), (None, "what an idiot, you moron")]
    found = {r.doc_id: r.score for r in toxicity.score(docs_of(probe), model).collect()}
    assert found[1] > 0.5 and found[2] < 0.5 and found[3] == found[4] < 0.5 and 0 <= found[None] <= 1


def test_toxicity_targets_are_posteriors_whatever_is_labelled(spark, docs_of, monkeypatch):
    draw = random.Random(3)
    rows = [(k, prose(draw) + (" you grumblefark " + prose(draw, 10) if k % 4 == 0 else "")) for k in range(200)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0 or k % 50 == 1)) for k in range(150)], LABELS)
    fit, seen = toxicity.fit_linear, []
    monkeypatch.setattr(toxicity, "fit_linear", lambda rows, target, *rest: seen.append(target) or fit(rows, target, *rest))
    model = toxicity.learn(docs_of(rows), labels)
    possible = model.label_model.posterior(np.arange(1 << len(toxicity.VOTERS)))
    assert len(seen[0]) == 200 and np.isin(seen[0], possible).all()


def test_label_model_discounts_correlated_voters():
    params = toxicity.Toxicity()
    rows = [(0b11, 1, 90), (0b00, 1, 10), (0b00, 0, 880), (0b11, 0, 20)]
    model = toxicity.LabelModel(rows, params)
    assert model.share[0] < 0.6 and model.share[1] < 0.6
    assert model.posterior(np.array([0b11]))[0] > 0.5 > model.posterior(np.array([0]))[0]


def test_blocked_cosines_are_exact(spark, docs_of):
    draw = random.Random(5)
    rows = [(k, prose(draw) if k % 3 else prose(draw).replace(" ", "### ")) for k in range(120)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(120)], LABELS)
    params = quality_knn.QualityKnn(neighbours_from=100, k=5)
    model = quality_knn.learn(docs_of(rows), labels, params)
    assert len(model.vectors) <= 100
    ((_, _, data, offsets),) = slices(pa.array([text for _, text in rows]), 1 << 30)
    counts = quality_knn.features(data, offsets, params)
    vectors = model.latent(counts).astype(float)
    for own, score in zip(vectors, model.score(counts, block=7)):
        cosine = model.vectors.astype(float) @ own
        best = np.argsort(-cosine)[:5]
        weight = np.maximum(cosine[best], 0) ** params.power
        assert abs((weight @ model.good[best] + 1e-3 * model.share) / (weight.sum() + 1e-3) - score) < 1e-2
    found = {r.doc_id: r.score for r in quality_knn.score(docs_of([(1, prose(draw)), (2, None), (3, prose(draw).replace(" ", "### "))]), model).collect()}
    assert found[1] > 0.5 > found[3] and abs(found[2] - model.share) < 1e-6


def test_nothing_to_learn_from(spark, docs_of, odd_rows):
    none = spark.createDataFrame([], LABELS)
    for operator in (toxicity, quality_knn):
        model = operator.learn(docs_of(odd_rows), none)
        rows = operator.score(docs_of(odd_rows), model).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert operator.learn(docs_of([]), none) is None
        assert operator.score(docs_of([]), None).collect() == []
        odd = spark.createDataFrame([(None, 1, 1), (4, None, None), (6, 1, 1), (6, 0, 0), (5, 0, 0)], LABELS)
        assert operator.learn(docs_of(odd_rows), odd) is not None
