"""Benchmark windows against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gridvoice.llm import decontaminate

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, gram string, size long, start string, item_id long, row long, n_words string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def brute(docs, items, width):
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, line in items:
            of = words(line)
            for k in range(max(1, len(of) - width + 1) if of else 0):
                window = of[k : k + width]
                for p in range(len(own) - len(window) + 1):
                    if own[p : p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        found.add(str(item))
        out.append((doc, len(own), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "g", 1, "s", 9, 5, "n") for d, t in docs], DOCS),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "É", "é", "a1", "of", "Big", "kind"])
    items = [(n, " ".join(word() for _ in range(size))) for n, size in enumerate([0, 1, 2, 4, 5, 7, 12, 12])]
    items += [(50, None), (51, "..."), (6, "of,of of-of")]
    docs = [(n, rng.choice([" ", ", ", "\n"]).join(word() for _ in range(rng.randrange(30)))) for n in range(40)]
    docs += [(100, items[6][1].upper()), (101, None), (102, ""), (103, "! ?"), (100, items[6][1]), (None, items[6][1])]
    docs.append((104, "filler " * 3000 + items[7][1]))
    return docs, items


@pytest.mark.parametrize("alike", [False, True])
@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_BYTES, 20 * decontaminate.GRAM_BYTES, 3 * decontaminate.GRAM_BYTES])
def test_matches_brute_force(few, monkeypatch, bound, alike):
    """With words, with hashes in one block, in several blocks; also where many windows have the hash of a gram."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
    if alike:
        exact = decontaminate._hash
        monkeypatch.setattr(decontaminate, "_hash", lambda *of: F.pmod(exact(*of), F.lit(9)))
    docs, items = case(3)
    got = decontaminate.contamination(*frames(few, docs, items), width=5).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got), key=repr)
    assert got == brute(docs, items, 5)


def test_empty_tables(few):
    docs, items = frames(few, [(1, "a b")], [])
    assert [tuple(r)[2:] for r in decontaminate.contamination(docs, items).collect()] == [(2, 0, None, [], 0, False)]
    docs, items = frames(few, [], [(1, "a b")])
    assert decontaminate.contamination(docs, items).count() == 0


def test_documents_and_spans_are_removed(few):
    docs, items = frames(
        few, [(1, "Keep this, drop THIS one now. End"), (2, "clean"), (None, "drop this one"), (3, None)], [(7, "drop this one")]
    )
    left = decontaminate.without_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    cut = decontaminate.without_spans(docs, items)
    assert cut.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "Keep this,    now. End", 2: "clean", None: "  ", 3: None}


def test_columns_of_any_name(few):
    names = ["_id", "_spans", "_first", "_pieces", "own_id", "own_hash", "spans", "split", "first", "a.b"]
    docs, items = frames(few, [(1, "now drop this one"), (2, "clean")], [(7, "drop this one")])
    docs = docs.select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    for got, ids in ((decontaminate.without_spans(docs, items), {1, 2}), (decontaminate.without_contaminated(docs, items), {2})):
        assert got.columns == docs.columns
        rows = got.collect()
        assert {r["doc_id"] for r in rows} == ids and all(r[n] == n for r in rows for n in names)


def test_a_very_long_text(few):
    """300,000 words with one window at the end, and one window over and over."""
    docs, items = frames(few, [(1, "word " * 300_000 + "drop this one"), (2, "drop this one " * 20_000)], [(7, "drop this one")])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (300_003, 3), 2: (60_000, 60_000)}
