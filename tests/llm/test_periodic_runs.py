from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tripmart.llm import queries
from tripmart.llm.periodic_runs import Extensions, PeriodicRuns, periodic_runs, runs_of

WORD = "[^\x20\x09-\x0d]+"


def brute_force(words, least_words=6, least_periods=4):
    """Maximal stretches of every period, by comparing words a period apart; only smallest periods stay."""
    n, found = len(words), []
    for q in range(1, n // least_periods + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(least_words, least_periods * q):
                if not any(words[at : at + length - r] == words[at + r : at + length] for r in range(1, q)):
                    found.append((at, length, q))
            at = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def expected(doc_id, text):
    """The contract's row, computed word by word."""
    words = re.findall(WORD, text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    from fractions import Fraction

    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2])) if runs else (None, None, None)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    collapsed = " ".join(word for k, word in enumerate(words) if k not in dropped)
    return (doc_id, len(runs), *best, milli, digest("".join(f"{s},{l},{q}\n" for s, l, q in runs)), digest(collapsed))


def texts(count, seed):
    draw = random.Random(seed)
    for k in range(count):
        words = [f"w{draw.randrange(draw.choice((2, 3, 8, 60)))}" for _ in range(draw.randrange(70))]
        if words and draw.random() < 0.5:
            part = words[draw.randrange(len(words)) :][: draw.randrange(1, 9)]
            words += part * draw.randrange(3, 8) + part[: draw.randrange(len(part))]
        yield k, draw.choice((" ", "\n", " \t")).join(words) + draw.choice(("", " ", "\x0b"))


@pytest.mark.parametrize("symbols", [1, 2, 3, 6])
def test_runs_equal_brute_force(symbols):
    draw = random.Random(symbols)
    for _ in range(300):
        words = [draw.randrange(symbols) for _ in range(draw.randrange(50))]
        found = runs_of(np.array(words, np.int64) + 1, PeriodicRuns())
        assert [tuple(run) for run in found.tolist()] == brute_force(words)


def test_extensions_equal_letter_by_letter():
    draw = np.random.default_rng(5)
    symbols = draw.integers(1, 4, 200)
    tree = Extensions(symbols)
    one, other = draw.integers(0, 200, (2, 500))
    one, other = one[one != other], other[one != other]

    def common(a, b):
        k = 0
        while max(a, b) + k < 200 and symbols[a + k] == symbols[b + k]:
            k += 1
        return k

    assert tree.common(one, other).tolist() == [common(a, b) for a, b in zip(one.tolist(), other.tolist())]
    for rank, sign in ((tree.rank, 1), (tree.reversed_rank(), -1)):
        in_order = sorted(range(201), key=lambda k: [sign * int(x) for x in symbols[k:]])
        assert rank[in_order].tolist() == list(range(201))


def test_rows_equal_brute_force(docs_of):
    rows = list(texts(250, 11))
    found = {r.key: r for r in periodic_runs(docs_of(rows)).collect()}
    for key, text in rows:
        words = re.findall(WORD, text)
        runs = brute_force(words)
        dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
        assert [tuple(run) for run in found[key].runs] == runs
        assert found[key].n_words == len(words)
        assert found[key].collapsed == " ".join(word for k, word in enumerate(words) if k not in dropped)


def test_other_bounds(docs_of):
    rows = [(1, "a b a b a b c c c"), (2, "a b " * 40)]
    found = {r.key: [tuple(run) for run in r.runs] for r in periodic_runs(docs_of(rows), PeriodicRuns(3, 3)).collect()}
    assert found == {1: [(0, 6, 2), (6, 3, 1)], 2: [(0, 80, 2)]}
    with pytest.raises(ValueError):
        PeriodicRuns(least_periods=2)


def test_query_equals_brute_force(spark, docs_of, odd_rows, tmp_path):
    rows = [*texts(400, 3), *((doc + 1000 if doc else doc, text) for doc, text in odd_rows[:-1]), (5000, "la " * 30_000 + "end")]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {kind for name, kind in found.dtypes if not name.endswith("sha256")} == {"bigint"}
    by_key = lambda row: (row[0] is None, row)
    wanted = [expected(*row) for row in rows if row[0] != 5000]
    held = [tuple(row) for row in found.collect()]
    assert sorted((row for row in held if row[0] != 5000), key=by_key) == sorted(wanted, key=by_key)
    (long,) = [row for row in held if row[0] == 5000]
    assert long[1:6] == (1, 0, 30_000, 1, 30_000_000)
    assert sum(row[1] > 0 for row in wanted) > 100


def test_empty_table(docs_of):
    assert periodic_runs(docs_of([])).collect() == []
