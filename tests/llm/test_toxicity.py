"""Segments against brute force, and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridvoice.llm import toxicity

DOCS = "doc_id long, text string, toxic string, token string, label string, n_tokens string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "t", "l", "n") for d, t in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame([(d, 1, t) for d, t in rows], "doc_id long, quality int, toxic int")


def brute_segments(values):
    """Maximal segments by their definition: the best segment first, then left and right of it."""
    if not values:
        return []
    sums = [(sum(values[a:b]), -a, b - a) for a in range(len(values)) for b in range(a + 1, len(values) + 1)]
    best, a, size = max(sums, key=lambda s: (s[0], -s[2]))
    if best <= 0:
        return []
    a = -a
    left, right = brute_segments(values[:a]), brute_segments(values[a + size :])
    return left + [(a, a + size - 1, best)] + [(x + a + size, y + a + size, s) for x, y, s in right]


@pytest.mark.parametrize("seed", range(30))
def test_segments(seed):
    rng = random.Random(seed)
    values = [rng.choice([-3, -2, -1.5, -1, 1, 2.25, 4.5]) + rng.random() / 100 for _ in range(rng.randrange(25))]
    level = np.concatenate([[0], np.cumsum(values)])
    at = np.flatnonzero(np.array(values) > 0)
    got = toxicity.segments(at, np.array(values)[at] if len(at) else np.array([]), level[at])
    want = brute_segments(values)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_decay_is_the_root():
    w, p = np.array([2.0, -0.1]), np.array([0.01, 0.99])
    decay = toxicity.decay_of(w, p)
    assert np.sum(p * np.exp(decay * w)) == pytest.approx(1)


def corpus(seed=0, n=400):
    rng = random.Random(seed)
    common = [f"w{k}" for k in range(60)]
    rows, marks = [], []
    for doc in range(n):
        words = [rng.choice(common) for _ in range(rng.randrange(20, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(["Vile", "nasty!", "SCUM"]) for _ in range(4)]
        rows.append((doc, " ".join(words)))
        marks.append((doc, int(toxic)))
    return rows, marks


def test_held_out_accuracy_and_passages(few):
    rows, marks = corpus()
    got = toxicity.score(frame(few, rows), labels(few, marks)).collect()
    truth = dict(marks)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    text = dict(rows)
    for r in got:
        if truth[r["doc_id"]] and r["passages"]:
            best = max(r["passages"], key=lambda s: s["score"])
            found = text[r["doc_id"]].lower().split()[best["first"] : best["last"] + 1]
            assert {"vile", "nasty!", "scum"} & set(found)


def test_labels_of_held_out_rows_have_no_effect(few):
    rows, marks = corpus()
    flipped = [(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in marks]
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score(frame(few, rows), labels(few, m)).collect()} for m in (marks, flipped))
    assert a == b


def test_odd_rows(few):
    rows, marks = corpus(n=100)
    odd = [(1000, None), (1001, ""), (None, "vile scum"), (3, "repeated id"), (1002, "vile " * 9000)]
    got = toxicity.score(frame(few, rows + odd), labels(few, marks + [(None, 1), (5, None)])).collect()
    assert len(got) == 105 and all(r["score"] is not None for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1000]["n_tokens"] == by[1001]["n_tokens"] == 0 and by[1000]["score"] < 0.5
    assert by[None]["held_out"]
    assert [r["score"] for r in toxicity.score(frame(few, rows[:3]), labels(few, [])).collect()] == [0.0] * 3
    assert toxicity.score(frame(few, []), labels(few, marks)).count() == 0


def plain_scores(rows, marks):
    """Evidence and score of each text by dictionaries, brute-force segments and bisection."""
    tokens = {d: re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for d, t in rows}
    known = {d: t for d, t in marks if t is not None and zlib.crc32(str(d).encode()) % 5}
    n, other, toxic = Counter(), Counter(), Counter()
    for d, own in tokens.items():
        n.update(set(own))
        if d in known:
            (toxic if known[d] else other).update(set(own))
    whole_toxic, whole_other, ratio = toxic.total(), other.total(), toxic.total() / n.total()
    weight = {}
    for t in n:
        a, b = toxic[t] + n[t] * ratio, other[t] + n[t] * ratio
        w = math.log(a / (2 * whole_toxic - a)) - math.log(b / (whole_other + whole_toxic - b))
        if (toxic[t] or other[t]) and abs(w / math.sqrt(1 / a + 1 / b)) >= 3:
            weight[t] = w
    chance = {t: other[t] / whole_other for t in weight}
    law = [*((weight[t], chance[t]) for t in weight), (-0.1, 1 - sum(chance.values()))]
    low, high = 0.0, 100.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(p * math.exp(min(middle * w, 700)) for w, p in law) < 1 else (low, middle)
    k = max(sum(chance[t] for t in weight if weight[t] > 0), 1e-9)
    evidence = {}
    for d, own in tokens.items():
        found = [(math.log(k * len(own)) - high * s, s) for _, _, s in brute_segments([weight.get(t, -0.1) for t in own])]
        counted = [e for e, _ in found if e < 0] or [e for e, s in sorted(found, key=lambda x: x[1])[-1:]]
        evidence[d] = sum(-math.log(-math.expm1(-math.exp(e))) if e > -30 else -e for e in counted)
    bins = Counter((known[d], min(math.floor(math.sqrt(evidence[d]) * 20), 400)) for d in known)
    y, x, size = (np.array(c, float) for c in zip(*((t, b / 20, c) for (t, b), c in bins.items())))
    a, b = toxicity.logistic(x, y, size)
    return evidence, {d: 1 / (1 + math.exp(-(a + b * math.sqrt(e)))) for d, e in evidence.items()}


def test_matches_a_plain_version_gathered_or_joined(few, monkeypatch):
    rows, marks = corpus(n=150)
    # toxic words that clean texts have as well, so that chance segments have a law
    rows += [(200 + n, f"w1 w2 w3 w4 w5 w6 w7 w8 {('vile', 'nasty', 'scum')[n % 3]} w9 w1 w2") for n in range(12)]
    marks += [(200 + n, 0) for n in range(12)]
    rows += [(500, None), (501, ""), (502, rows[0][1]), (503, "vile Ünder scum " * 9), (504, rows[0][1])]
    evidence, scores = plain_scores(rows, marks)
    for limit in (64 << 20, 0):
        monkeypatch.setattr(toxicity.common, "BROADCAST_BYTES", limit)
        got = toxicity.score(frame(few, rows), labels(few, marks)).collect()
        assert len(got) == len(rows) and max(r["evidence"] for r in got) > 5
        for r in got:
            assert r["evidence"] == pytest.approx(evidence[r["doc_id"]], rel=5e-3, abs=5e-3)
            assert r["score"] == pytest.approx(scores[r["doc_id"]], abs=0.02)
