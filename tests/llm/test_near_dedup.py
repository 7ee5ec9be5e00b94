from __future__ import annotations

import random
import re

import pytest

from tripmart.llm.components import components
from tripmart.llm.near_dedup import NearDedup, keep_first, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute_force(rows, size, percent=80):
    """(n_shingles, component) by id, comparing all pairs."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {doc: (len(sets[doc]), find(doc)) for doc in ids}


def edited(words, changes, draw):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_matches_all_pairs(docs_of, size):
    draw = random.Random(size)
    rows = []
    for _ in range(4):
        base = [f"w{draw.randrange(60)}" for _ in range(80)]
        rows += [(len(rows) + k, edited(base, draw.randrange(8), draw)) for k in range(40)]
    rows += [(1000 + k, rows[k][1].upper()) for k in range(5)]
    found = near_duplicates(docs_of(rows), NearDedup(shingle_words=size)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_chain_of_links_is_one_component(docs_of):
    words = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join(words[: 100 - 6 * k])) for k in range(8)]
    found = near_duplicates(docs_of(rows), NearDedup(shingle_words=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows, 2)


def test_odd_rows(docs_of, odd_rows):
    found = near_duplicates(docs_of(odd_rows), NearDedup(shingle_words=2)).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert by_id[1] == by_id[2][:1] + (1, True) and by_id[3] == (0, 3, True)
    assert by_id[None] == (3, None, True)
    assert by_id[5] == (2, 5, True) and sum(r.doc_id == 5 for r in found) == 2
    assert by_id[4] == (1, 4, True)


def test_repeated_ids_with_differing_texts(docs_of):
    draw = random.Random(5)
    base = [[f"{name}{draw.randrange(60)}" for _ in range(80)] for name in "abcdefgh"]
    rows = [(5, " ".join(base[0])), (5, " ".join(base[1])), (9, " ".join([*base[1], "more"])), (11, " ".join([*base[0], "more"]))]
    rows += [(3, " ".join([*base[2], "x"])), (7, " ".join(base[2])), (7, " ".join(base[3])), (8, " ".join([*base[3], "y"])), (8, None), (8, " ".join(base[4]))]
    rows += [(20, " ".join(base[5])), (20, " ".join(base[5])), (21, " ".join(base[6])), (22, " ".join(base[4])), (23, " ".join(base[6]))]
    rows += [(2, " ".join(base[7])), (2, "few words"), (2, "few WORDS"), (6, "other")]
    for partitions in (1, 5):
        draw.shuffle(rows)
        found = near_duplicates(docs_of(rows).repartition(partitions), NearDedup(shingle_words=2)).collect()
        assert len(found) == len(rows)
        assert all(r.n_shingles == len(shingles(text, 2)) for r, (_, text) in zip(sorted(found, key=lambda r: (r.doc_id, r.n_shingles)), sorted(rows, key=lambda r: (r[0], len(shingles(r[1], 2))))))
        groups = {5: 5, 9: 5, 11: 5, 3: 3, 7: 3, 8: 3, 22: 3, 20: 20, 21: 21, 23: 21, 2: 2, 6: 6}
        assert {(r.doc_id, r.component_id) for r in found if r.n_shingles} == set(groups.items())
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).collect() == []


def test_keep_first_returns_the_columns(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (7, "SAME row HERE"), (8, "another text")])
    kept = keep_first(docs, NearDedup(shingle_words=2))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 5, 6, 8]


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(0, 200)] + [(500, 400), (400, 450), (7, 7)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {500: 400, 450: 400}


def test_signature_keys_meet_within_the_distance():
    import numpy as np
    import pyarrow as pa

    from tripmart.llm.near_dedup import key_rows

    params, draw = NearDedup(), np.random.default_rng(3)
    one = draw.integers(0, 1 << 16, params.symbols).astype(np.uint16)
    for _ in range(50):
        other = one.copy()
        other[draw.choice(params.symbols, params.guaranteed_distance, replace=False)] += np.uint16(1)
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([one.tobytes(), other.tobytes()])], ["rep", "signature"])
        (keys,) = key_rows(params)(iter([batch]))
        values = keys.column(0).to_pylist()
        assert set(values[: params.symbols]) & set(values[params.symbols :])
