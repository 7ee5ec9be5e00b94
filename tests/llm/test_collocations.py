from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tripmart.llm.collocations import Collocations, chunk_rows, collocations, dictionary, phrase_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        words = re.findall("[^\x20\x09]+", piece)
        if words:
            yield words


def grams(rows, most):
    """Counts of the phrases of one to `most` words by language."""
    found = Counter()
    for lang, text in rows:
        for words in pieces_of(text):
            for size in range(1, most + 1):
                found.update(("und" if lang is None else lang, " ".join(words[k : k + size])) for k in range(len(words) - size + 1))
    return found


def brute_force(rows, params):
    counts = grams([(lang, text) for _, text, lang in rows], params.most_words)
    candidates = {key: f for key, f in counts.items() if f >= params.least_count and " " in key[1]}
    longest = Counter()
    for (lang, phrase), f in candidates.items():
        words = phrase.split(" ")
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                part = (lang, " ".join(words[k : k + size]))
                longest[part] = max(longest[part], f)
    found = {}
    for (lang, phrase), a in candidates.items():
        if 100 * longest[lang, phrase] >= params.covered_percent * a and longest[lang, phrase]:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    rows = []
    for lang, own in found.items():
        n = sum(f for (other, phrase), f in counts.items() if other == lang and " " not in phrase)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[: params.top], start=1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(rows)


def corpus(seed, count=150):
    draw = random.Random(seed)
    vocabulary = [f"W{k}" if k % 3 else f"é{k}" for k in range(12)]
    passages = [[draw.choice(vocabulary) for _ in range(draw.randrange(5, 40))] for _ in range(6)]
    rows = []
    for k in range(count):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(30))] + draw.choice(passages) + ["la"] * draw.randrange(9)
        text = "".join(word + draw.choice((" ", " ", " ", "  ", "\t", ". ", "\n", ";")) for word in words)
        rows.append((k, text, draw.choice(("en", "en", "fr", "und", None))))
    return rows


@pytest.mark.parametrize("modulus", [1, 2, 16])
def test_matches_counting_everything(docs_of, modulus):
    rows = corpus(modulus)
    params = Collocations(least_count=4, modulus=modulus, top=40, salts=3, filter_bits=12)
    found = collocations(docs_of(rows), params)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in found.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    assert sorted(tuple(row) for row in found.collect()) == brute_force(rows, params)


def test_counts_are_exact_though_the_bitmaps_are_full(docs_of):
    rows = corpus(9)
    params = Collocations(least_count=3, filter_bits=7)
    single, phrases, _ = phrase_counts(docs_of(rows), params)
    held = {(r.lang, r.phrase): r.f for r in single.collect()} | {(r.lang, r.phrase): r.f for r in phrases.collect()}
    assert held == {key: f for key, f in grams([(lang, text) for _, text, lang in rows], 4).items() if f >= 3}


def test_chunks_overlap_and_cover_each_phrase_once():
    params, draw = Collocations(modulus=3), random.Random(4)
    words = [f"w{draw.randrange(30)}" for _ in range(400)]
    (found,) = chunk_rows(params)(iter([pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([" ".join(words)])], ["lang", "text"])]))
    chunks = [chunk.split(" ") for chunk in found.column(1).to_pylist()]
    assert found.column(2).to_pylist() == [False] * (len(chunks) - 1) + [True]
    assert len(chunks) > 50
    rebuilt = [word for chunk in chunks[:-1] for word in chunk[:-3]] + chunks[-1]
    assert rebuilt == words
    for one, other in zip(chunks, chunks[1:]):
        assert one[-3:] == other[:3]


def test_repeated_text_is_one_dictionary_entry(docs_of):
    rows = [(k, "the very same passage of some words, again", "en") for k in range(50)]
    found = dictionary(docs_of(rows), Collocations(), "lang", "text").collect()
    assert sorted((r.chunk, r.times) for r in found if r.last) == [("again", 50), ("the very same passage of some words", 50)] or all(r.times == 50 for r in found)


def test_odd_rows(docs_of, odd_rows):
    params = Collocations(least_count=2)
    rows = [(doc, text, "en") for doc, text in odd_rows] + [(50, "same row here", None), (51, "same ROW here!", "")]
    found = sorted(tuple(row) for row in collocations(docs_of([(k, text, lang) for k, text, lang in rows]), params).collect())
    assert found == brute_force(rows, params)


def test_empty_table(docs_of):
    assert collocations(docs_of([])).collect() == []
