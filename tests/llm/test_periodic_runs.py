"""Runs on the grammar against a search over all periods, and the query against the contract in plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridvoice.llm import periodic_runs as P
from gridvoice.llm import queries


def brute(words):
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def as_tuples(rows):
    return sorted(map(tuple, rows.tolist()))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(1, 9), st.integers(1, 70)), max_size=6
    )
)
def test_pieces_of_powers(parts):
    words = [w for root, times, cut in parts for w in (root * times)[:cut]]
    assert as_tuples(P.word_runs(words)) == brute(words)


@pytest.mark.parametrize("seed", range(60))
def test_random_texts(seed):
    rng = random.Random(seed)
    base = [rng.randrange(1000) for _ in range(rng.randrange(1, 60))]
    words = []
    for _ in range(rng.randrange(1, 9)):
        words += base * rng.randrange(1, 4) + [rng.randrange(rng.choice([1, 2, 1000])) for _ in range(rng.randrange(0, 30))]
    assert as_tuples(P.word_runs(words)) == brute(words)


def test_fibonacci_words():
    x, y = [0], [0, 1]
    for _ in range(9):
        x, y = y, y + x
    assert as_tuples(P.word_runs(y * 3)) == brute(y * 3)


def test_grammar_derives_the_text():
    rng = random.Random(1)
    text = [rng.randrange(4) for _ in range(500)]
    fresh, rules, sequence = P.re_pair(text)
    assert rules

    def expand(x):
        return [x] if x < fresh else [t for part in rules[x - fresh] for t in expand(part)]

    assert [t for x in sequence for t in expand(x)] == text
    pairs = list(zip(sequence, sequence[1:]))
    assert all(pairs.count(p) == 1 for p in pairs if p[0] != p[1])


def test_long_texts_take_seconds():
    assert P.word_runs([7] * 300_000).tolist() == [[0, 300_000, 1]]
    rng = random.Random(2)
    base = [rng.randrange(5000) for _ in range(30_000)]
    assert P.word_runs([9999] + base * 4 + [9998]).tolist() == [[1, 120_001, 30_000]]


def test_only_long_runs_with_three_periods():
    some = list(range(100, 140))
    assert len(P.word_runs(some + [1] * 23 + some)) == 0
    assert P.word_runs(some + [1] * 24 + some).tolist() == [[40, 64, 1]]
    twelve = list(range(12))
    assert len(P.word_runs(some + twelve * 2 + twelve[:11] + some)) == 0
    assert P.word_runs(some + twelve * 3 + some).tolist() == [[40, 76, 12]]
    with pytest.raises(ValueError):
        P.Settings(least_words=10)


def test_collapsed_keeps_one_period():
    words = [b"a"] + [b"x", b"y"] * 20 + [b"b"]
    assert P.collapsed(words, P.word_runs(words)) == b"a x y b"
    assert P.collapsed([], P.word_runs([])) == b""


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted((s, e - s, q) for s, e, q in brute(words))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = np.zeros(n, bool)
    for s, length, q in runs:
        gone[s + q : s + length] = True
    kept = b" ".join(w for w, dropped in zip(words, gone) if not dropped)
    return (
        (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2])
        + (hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),)
        + (hashlib.sha256(kept).hexdigest(), n)
    )


def test_query_equals_contract(few, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(260):
        n = rng.choice([0, 1, 5, 23, 24, 60, 150])
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(rng.choice(["ä", "b", "c c"]) for _ in range(n))))
    rows += [(300, None), (301, ""), (302, " \n "), (None, "a " * 40), (303, "x y " * 30), (303, "x y " * 30), (-5, "q " * 99)]
    docs = few.createDataFrame(rows, "doc_id long, text string")
    # extra columns with the operator's own names
    docs = docs.withColumns({c: F.lit("other") for c in ("runs", "n_words", "best", "start", "text_collapsed")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.QUERIES["op11_periodic_runs"](few, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert sum(r[1] for r in got) > 10


def test_empty_table(few, tmp_path):
    few.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES["op11_periodic_runs"](few, str(tmp_path)).count() == 0
