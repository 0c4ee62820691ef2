"""Near duplicates against brute force on full sets."""

import random
import re

import numpy as np
import pytest

from gridvoice.llm import components, minhash, shingles

SCHEMA = "doc_id long, text string, id string, key long, component string, lang string, source string, n_chars long"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "c", "en", "s", 0) for d, t in rows], SCHEMA)


def brute(rows, words, percent):
    sets = {}
    for doc, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
        whole = [tuple(found[i : i + words]) for i in range(len(found) - words + 1)] or [tuple(found)]
        sets[doc] = set(whole) if found else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            union = len(sets[a] | sets[b])
            if union and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * union:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def corpus(seed, groups=12, copies=9, size=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(60))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(5, size))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = word().upper()
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return list(enumerate(texts))


ODD = [(900, None), (901, ""), (902, " \t\n "), (903, "one"), (904, "ONE"), (905, "two words"), (906, "é É"), (907, "É é"), (908, "x " * 5000)]


@pytest.mark.parametrize("settings", [minhash.Settings(words=3, percent=85), minhash.Settings(words=5, percent=80, hot=2, block=3)])
def test_matches_brute_force(few, settings):
    rows = corpus(settings.words) + ODD
    got = minhash.near_duplicates(frame(few, rows), settings).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, settings.words, settings.percent)


def test_repeated_rows_null_ids_and_empty_tables(few):
    text = "a b c d e f g"
    got = minhash.near_duplicates(frame(few, [(1, text), (1, text), (5, text), (None, text)])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (5, 1, False)]
    left = minhash.without_copies(frame(few, [(1, text), (1, text), (5, text), (None, text), (7, None)]))
    assert left.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 7]
    assert minhash.near_duplicates(frame(few, [])).count() == 0


def test_components_of_paths_and_stars(few):
    path = [(i, i + 1) for i in range(1, 40)] + [(100, 300), (300, 200), (7, 7)]
    edges = few.createDataFrame([*path, (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 200: 100, 300: 100}


def test_word_hashes_do_not_depend_on_the_place():
    import pyarrow as pa

    texts = ["alpha beta", None, "", "x" * 70000 + " alpha", " beta\talpha\n"]
    raw, offsets = shingles.text_bytes(pa.array(texts))
    starts, ends, first = shingles.words(raw, offsets)
    hashes = shingles.word_hashes(raw, starts, ends)
    assert first.tolist() == [0, 2, 2, 2, 4, 6]
    assert hashes[0] == hashes[3] == hashes[5] and hashes[1] == hashes[4]
    assert len(np.unique(hashes)) == 3


def test_low_bytes_that_agree_are_no_shared_bucket(few):
    settings = minhash.Settings(words=3, percent=85)
    size = settings.bands * settings.rows
    members = np.arange(40, dtype=np.uint64).tobytes()
    rows = []
    for doc in (1, 2):
        # the minima of the first band agree in their low bytes only; the pair's one bucket is that of the fourth
        keys = [1000 * doc + band for band in range(settings.bands)]
        keys[3] = 77
        rows.append((77, 3, doc, doc, 40, bytearray(size), keys, bytearray(members)))
    schema = "key long, band int, id long, component long, n_shingles long, sig binary, keys array<long>, members binary"
    got = minhash._within_blocks(few.createDataFrame(rows, schema), settings).collect()
    assert [(r["a"], r["b"]) for r in got] == [(1, 2)]


def prose(start, n=60):
    return " ".join(f"w{start + k}" for k in range(n))


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [1, 0, 2, 3], [3, 2, 1, 0]])
def test_rows_of_one_id_are_linked_each_by_its_text(few, order):
    one, two = prose(0), prose(1000)
    rows = [(5, one), (5, two), (8, one + " end"), (9, two + " end")]
    docs = few.createDataFrame([rows[k] for k in order], "doc_id long, text string").coalesce(1)
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [(5, 5, True), (5, 5, True), (8, 5, False), (9, 5, False)]
    assert sorted(map(tuple, minhash.without_copies(docs).collect())) == sorted([(5, one), (5, two)])


def test_repeated_ids_among_large_ones(few):
    """The smallest id of a component belongs to a row whose id repeats, and one set has both kinds of rows."""
    one, two, three = prose(0), prose(1000), prose(2000)
    rows = [(3, one), (3, two), (2, one + " end"), (7, one), (8, two + " end"), (9, three), (9, three), (4, None), (4, ""), (None, one)]
    docs = few.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()), key=str)
    want = [(3, 2, False), (3, 3, True), (2, 2, True), (7, 2, False), (8, 3, False), (9, 9, True), (9, 9, True), (4, 4, True), (4, 4, True), (None, None, True)]
    assert got == sorted(want, key=str)
    left = sorted(map(tuple, minhash.without_copies(docs).collect()), key=str)
    assert left == sorted([(3, two), (2, one + " end"), (9, three), (4, None), (4, ""), (None, one)], key=str)


def test_clashing_names(few):
    from pyspark.sql import functions as F

    names = ["_gone", "own_id", "OWN_HASH", "same", "node", "id", "text_hash", "keys"]
    docs = few.createDataFrame([(1, prose(0)), (2, prose(0)), (2, prose(0)), (3, prose(500)), (3, prose(500))], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(c) for c in names})
    left = minhash.without_copies(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 3]
