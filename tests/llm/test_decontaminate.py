from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from tripmart.llm.decontaminate import BITS, Decontaminate, HammingIndex, leaks, without_leaks

ITEMS = "item_id long, text string"


def words_of(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items):
    """Best (similarity, first word, words) of all windows of all texts, by (doc, item)."""
    found = {}
    for item, item_text in items:
        own = words_of(item_text)
        if not own:
            continue
        size = min(5, len(own))
        wanted = Counter(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
        for doc, text in docs:
            words = words_of(text)
            grams = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
            spread = min(wanted.total(), len(grams))
            for start in range(len(grams) - spread + 1 if grams else 0):
                window = Counter(grams[start : start + spread])
                least = (window & wanted).total()
                if 100 * least >= 80 * (window | wanted).total():
                    rank = (round(least / (window | wanted).total(), 9), -start, spread + size - 1)
                    found[doc, item] = max(found.get((doc, item), rank), rank)
    return {key: (similarity, -start, length) for key, (similarity, start, length) in found.items()}


def as_dict(frame):
    return {(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word, r.n_words) for r in frame.collect()}


def test_matches_all_windows(spark, docs_of):
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randrange(8, 40)))) for k in range(25)]
    docs = []
    for k in range(120):
        filler = draw.choices(vocabulary, k=draw.randrange(0, 200))
        passage = items[draw.randrange(25)][1].split()
        for _ in range(draw.randrange(4)):
            passage[draw.randrange(len(passage))] = "changed"
        at = draw.randrange(len(filler) + 1)
        docs.append((k, " ".join([*filler[:at], *(passage if k % 3 else passage[: len(passage) * 2 // 3]), *filler[at:]]).title()))
    found = as_dict(leaks(docs_of(docs), spark.createDataFrame(items, ITEMS), Decontaminate()))
    expected = brute_force(docs, items)
    assert found == expected and 20 < len(found) < 120
    blocks = as_dict(leaks(docs_of(docs), spark.createDataFrame(items, ITEMS), Decontaminate(block_chars=700)))
    assert blocks == expected


def test_odd_rows_and_items(spark, docs_of, odd_rows):
    items = [(1, None), (2, ""), (None, "same row here"), (3, "Same, row HERE!"), (4, "one"), (4, "one")]
    found = as_dict(leaks(docs_of(odd_rows), spark.createDataFrame(items, ITEMS)))
    assert found == {(5, 3): (1.0, 0, 3), (4, 4): (1.0, 0, 1)}
    kept = without_leaks(docs_of(odd_rows), spark.createDataFrame(items, ITEMS))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "6", "None"]
    assert kept.columns == docs_of(odd_rows).columns


def test_empty_tables(spark, docs_of):
    assert leaks(docs_of([]), spark.createDataFrame([(1, "a b c")], ITEMS)).collect() == []
    assert leaks(docs_of([(1, "a b c")]), spark.createDataFrame([], ITEMS)).collect() == []


def test_hamming_index_finds_everything_within_the_radius():
    draw = np.random.default_rng(2)
    items = draw.integers(0, 2, (40, BITS)).astype(np.uint8)
    probes = np.concatenate([items, items, draw.integers(0, 2, (40, BITS)).astype(np.uint8)])
    for k, probe in enumerate(probes[:80]):
        probe[draw.choice(BITS, k % 45, replace=False)] ^= 1
    window, item, distance = HammingIndex(items, 39).near(probes)
    all_distances = (probes[:, None, :] != items[None, :, :]).sum(2)
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(all_distances <= 39))))
    assert (all_distances[window, item] == distance).all()
