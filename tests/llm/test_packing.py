"""Token ids against the library, and the plan's invariants."""

import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridvoice.llm import packing
from gridvoice.llm.word_tokens import Encoder

VOCABULARY = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
LIBRARY = Tokenizer.from_str(VOCABULARY)
LIBRARY.encode_special_tokens = True
ENCODER = Encoder(VOCABULARY)
DOCS = "doc_id long, text string, piece string, start string, length string, run string, n long"


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(texts):
    ids, offsets = ENCODER.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library(t) for t in texts]


def test_every_plain_character():
    check([f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(1, 0x300)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("'sStTmMdDlLrRvVeE .\n1é’"), st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]))), max_size=5))
def test_any_text(texts):
    check(texts)


def test_contractions_and_others():
    check(["it's I'm we're THEY'LL don't ''s x'' 'd", "can't've 're'll ve'", None, "", "  ", "<|endoftext|> a", "日本語 ǅ İ ẞ Σς", "'", "'s", "s'", "12'3"])


def test_forgetting_changes_nothing(monkeypatch):
    from gridvoice.llm import word_tokens

    monkeypatch.setattr(word_tokens, "REMEMBERED", 5)
    encoder = Encoder(VOCABULARY)
    for text in ("one two three four", "four three", "two one six seven eight nine ten"):
        assert encoder.encode([text])[0].tolist() == library(text)


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    counts = np.zeros(capacity + 1, np.int64)
    sizes = np.clip(rng.lognormal(2.5, 0.9, 5000).astype(int) + 1, 1, capacity)
    np.add.at(counts, sizes, 1)
    plan = packing.plan_of(counts, capacity)
    used = np.zeros_like(counts)
    for pattern, repeats in plan:
        assert sum(pattern) <= capacity and repeats > 0
        for length in pattern:
            used[length] += repeats
    assert (used == counts).all()
    sequences = sum(r for _, r in plan)
    assert sequences <= -(-int(sizes.sum()) // capacity) * 1.01 + 1


def test_fit_solves_least_squares():
    counts = np.zeros(11, np.int64)
    counts[[3, 7, 5]] = [30, 30, 20]
    patterns = packing.exact_patterns(counts, 10)
    x = packing.fit(patterns, counts)
    assert {tuple(int(v) for v in p if v): round(float(k)) for p, k in zip(patterns, x) if k > 0.5} == {(7, 3): 30, (5, 5): 10}


def test_round_trip(few, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 3)
    rng = random.Random(0)
    texts = [" ".join(rng.choice(["cat", "it's", "été", "42"]) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["same text"] * 20 + [None, "", "word " * 300]
    rows = [(n, t, "p", "s", "l", "r", 1) for n, t in enumerate(texts)]
    df = few.createDataFrame(rows, DOCS)
    got = packing.pack(packing.pieces(df, VOCABULARY, 32), 32).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for n, text in enumerate(texts):
        ids = np.array([*library(text), 0], "<u4")
        total += len(ids)
        want = [(k, at, len(ids[at : at + 32]), zlib.crc32(ids[at : at + 32].tobytes())) for k, at in enumerate(range(0, len(ids), 32))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[n]) == want
    for places in by_sequence.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto
            upto += length
        assert upto <= 32
    assert len(by_sequence) <= -(-total // 32) + 4


def test_repeated_and_null_ids_and_empty_table(few):
    df = few.createDataFrame([(1, "a b", *"psdr", 1), (1, "a b", *"psdr", 1), (None, "c", *"psdr", 1)], DOCS)
    got = packing.pack(packing.pieces(df, VOCABULARY, 8), 8).collect()
    assert len(got) == 3 and len({(r["sequence_id"], r["offset"]) for r in got}) == 3
    assert packing.pack(packing.pieces(df.limit(0), VOCABULARY)).count() == 0


def test_special_tokens_as_in_the_library(few):
    plain = Tokenizer.from_str(VOCABULARY)
    texts = ["a <|endoftext|> b", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> x", "<|endoftext", "no token 漢 <|endoftext|>", "plain words", "", None]
    df = few.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pieces(df, VOCABULARY).collect() if texts[r["doc_id"]]}
    want = {n: plain.encode(t, add_special_tokens=False).ids + [packing.END_ID] for n, t in enumerate(texts) if t}
    assert want[0][:-1] != library(texts[0])
    assert got == {n: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for n, ids in want.items()}
