from __future__ import annotations

import numpy as np
import pytest

from tripmart.llm import queries
from tripmart.llm.vantage_trees import Search, Tree, VpSearch, build, search

SCHEMA = "vec_id long, embedding array<float>, label int, id string, cell string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(key, vector, 1, "x", "y", 0.5) for key, vector in rows], SCHEMA)


def brute_force(rows, k, every=20):
    """Rows (query, rank, id, score) by comparing all pairs in order of components."""
    usable = {}
    for key, vector in rows:
        if key is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            own = [float(np.float32(x)) for x in vector]
            usable[key] = min(own, usable.get(key, own))
    found = []
    for query in sorted(key for key in usable if key % every == 0):
        scored = []
        for key, vector in usable.items():
            if key != query and len(vector) == len(usable[query]):
                total = 0.0
                for x, y in zip(usable[query], vector):
                    total += x * y
                scored.append((-total, key))
        found += [(query, rank, key, -total) for rank, (total, key) in enumerate(sorted(scored)[:k], start=1)]
    return found


SMALL = dict(neighbours=5, pivots=4, shard_rows=24, leaf_rows=6, block_queries=3)


def searched(spark, rows, params, every=20):
    vectors = frame(spark, rows)
    found = search(build(vectors, params), vectors.where(f"vec_id % {every} = 0"), params)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return sorted(tuple(row) for row in found.collect())


def test_factor_one_equals_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(k, (draw.normal(size=8) * draw.uniform(0.5, 2)).tolist()) for k in range(300)]
    assert searched(spark, rows, VpSearch(factor=1.0, **SMALL), 5) == brute_force(rows, 5, 5)


def test_ties_and_copies(spark):
    draw = np.random.default_rng(3)
    rows = [(k, draw.integers(-2, 3, 4).astype(float).tolist()) for k in range(150)]
    rows += [(k, [1.0, 2.0, -1.0, 0.0]) for k in range(1000, 1120)]
    assert searched(spark, rows, VpSearch(factor=1.0, **SMALL)) == brute_force(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, []), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0])]
    rows += [(140, [2.0, 1.0]), (140, [2.0, 1.0]), (160, [3.0, 0.0]), (160, [1.0, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (180, [1.0, 0.0, 2.0])]
    for params in (VpSearch(factor=1.0, **SMALL), VpSearch(factor=1.0, **{**SMALL, "pivots": 1})):
        assert searched(spark, rows, params) == brute_force(rows, 5)


def test_empty_tables(spark):
    assert searched(spark, [], VpSearch()) == []
    assert searched(spark, [(3, [0.0])], VpSearch()) == []
    assert searched(spark, [(20, [1.0])], VpSearch()) == []


def test_larger_factors_compare_less():
    draw = np.random.default_rng(4)
    centers = draw.normal(size=(12, 8)) * 4
    points = centers[draw.integers(0, 12, 2000)] + draw.normal(size=(2000, 8)) * 0.3
    tree = Tree(points, [[k] for k in range(2000)], float((points**2).sum(1).max()), 32)
    asked = np.arange(0, 2000, 20)
    compared, least = [], np.partition(points[asked] @ points.T, -7, 1)[:, -6]
    for factor in (1.0, 2.0, 4.0):
        done = Search(tree, asked, points[asked], np.full(100, -np.inf), VpSearch(neighbours=5, factor=factor)).run()
        compared.append(done.compared)
        if factor == 1.0:
            assert compared[0] < 0.7 * 100 * 2000
            assert np.all(done.scores[:, -1] >= least - 1e-9)
    assert compared[0] > compared[1] > compared[2]


def test_query_recall(spark, tmp_path):
    draw = np.random.default_rng(6)
    rows = [(k, (x / np.linalg.norm(x)).tolist()) for k, x in enumerate(draw.normal(size=(6000, 64)))]
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.op12_vantage_trees(spark, str(tmp_path)).collect()
    vectors = np.array([vector for _, vector in rows], np.float32).astype(float)
    scores = vectors[::20] @ vectors.T
    scores[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    wanted = {(20 * q, key) for q, own in enumerate(np.argsort(-scores, 1)[:, :20].tolist()) for key in own}
    assert len(found) == 6000
    assert len({(row.query_id, row.vec_id) for row in found} & wanted) >= 0.95 * len(wanted)
    assert all(row.score == pytest.approx(float(vectors[row.query_id] @ vectors[row.vec_id]), abs=1e-12) for row in found)
