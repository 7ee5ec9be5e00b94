from __future__ import annotations

import random

import numpy as np
import pytest

from tripmart.llm.language import LanguageId, identify, learn, viterbi

SYLLABLES = {"aa": ["the", "ing", "and", "er"], "bb": ["ción", "ar", "os", "que"], "cc": ["ово", "ный", "про", "ста"]}


def sentence(lang, draw, words=30):
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randrange(2, 4))) for _ in range(words))


def test_viterbi_is_optimal():
    draw = np.random.default_rng(1)
    for _ in range(60):
        n, lengths = draw.integers(1, 5), draw.integers(0, 30, 6)
        first = np.concatenate([[0], np.cumsum(lengths)])
        scores = draw.normal(0, 2, (first[-1], n)).astype(np.float32)
        labels = viterbi(scores, first, 2.0, 7)
        for begin, end in zip(first[:-1], first[1:]):
            if begin == end:
                continue
            best = scores[begin].astype(float)
            for t in range(begin + 1, end):
                best = np.maximum(best, best.max() - 2.0) + scores[t]
            own = sum(float(scores[t, labels[t]]) for t in range(begin, end)) - 2.0 * np.count_nonzero(np.diff(labels[begin:end]))
            assert abs(own - best.max()) < 1e-3


def test_spans_of_mixed_text(docs_of):
    draw = random.Random(1)
    docs = docs_of([(k, sentence(lang, draw, 60), lang) for k, lang in enumerate([*SYLLABLES] * 20)])
    model = learn(docs, LanguageId())
    assert model.languages == ["aa", "bb", "cc"]
    mixed = [sentence("aa", draw), sentence("bb", draw), sentence("cc", draw, 50)]
    text = "! ".join(mixed)
    (row,) = identify(docs_of([(1, text)]), model).collect()
    assert row.lang_pred == "cc" and 0.3 < row.score < 0.8
    assert [span.lang for span in row.spans] == ["aa", "bb", "cc"]
    at = len(mixed[0]) + 2
    assert (row.spans[0].begin, row.spans[0].end, row.spans[1].begin) == (0, len(mixed[0]), at)
    # A script that one language uses leaves it as the only candidate.
    (row,) = identify(docs_of([(1, "щщщ")]), model).collect()
    assert row.lang_pred == "cc"


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of([(k, text, "aa") for k, text in odd_rows] + [(90, "123 --", "aa"), (91, None, "bb"), (92, "words", None)])
    model = learn(docs, LanguageId())
    found = {r.doc_id: r for r in identify(docs, model).collect()}
    assert found[1].lang_pred == found[2].lang_pred == found[90].lang_pred == "und" and found[90].score == 0 and found[90].spans == []
    assert found[6].lang_pred == "aa" and found[6].score == 1
    assert identify(docs_of([]), model).collect() == []


def test_no_model(docs_of):
    assert learn(docs_of([(1, "words")]), LanguageId()) is None
    (row,) = identify(docs_of([(1, "words")]), None).collect()
    assert (row.lang_pred, row.score) == ("und", 0)


def test_no_language_is_left_out(spark, docs_of):
    draw = random.Random(5)
    docs = docs_of([(k, sentence(lang, draw), lang) for k, lang in enumerate(["aa", "aa", "bb", "cc"])])
    assert learn(docs, LanguageId(most_languages=3)).languages == ["aa", "bb", "cc"]
    with pytest.raises(ValueError, match="more than 2 languages"):
        learn(docs, LanguageId(most_languages=2))
