"""The automaton against cutting words piece by piece."""

import random
import re
import time
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from gridvoice.llm import wordpiece

VOCABULARY = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
PIECES = wordpiece.byte_vocabulary(VOCABULARY)
DOCS = "doc_id long, text string, id string, n_words string, n_tokens string"


def greedy(word, pieces):
    longest = max(map(len, pieces))
    count = at = 0
    while at < len(word):
        at += next(n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in pieces)
        count += 1
    return count


def lengths(automaton, words, lead):
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - np.array([len(w) for w in words])
    return automaton.lengths(raw, starts, ends, lead).tolist()


@pytest.mark.parametrize("seed", range(5))
def test_small_vocabularies(seed):
    rng = random.Random(seed)
    pieces = {bytes([b]) for b in range(256)} | {bytes(rng.choices(b"abc", k=rng.randrange(2, 7))) for _ in range(40)}
    words = [bytes(rng.choices(b"abcd", k=rng.randrange(1, 40))) for _ in range(300)]
    automaton = wordpiece.Automaton(sorted(pieces))
    assert lengths(automaton, words, None) == [greedy(w, pieces) for w in words]


def test_missing_bytes_are_refused():
    with pytest.raises(ValueError):
        wordpiece.Automaton([b"a", b"ab"])


def test_documents(few):
    rng = random.Random(8)
    texts = [None, "", " \n", "hello", "Hello, wörld! 日本  x", "a" * 50_000, "the cat " * 2000]
    texts += [" ".join(rng.choice(["token", "Automaton", "ünïcode", "<|endoftext|>", "x" * rng.randrange(1, 20)]) for _ in range(30)) for _ in range(20)]
    df = few.createDataFrame([(n, t, "i", "w", "t") for n, t in enumerate(texts)] + [(None, "a b", "", "", ""), (3, "again", "", "", "")], DOCS)
    got = [tuple(r) for r in wordpiece.token_counts(df, VOCABULARY).collect()]
    known = set(PIECES)
    want = []
    for doc, text in [*enumerate(texts), (None, "a b"), (3, "again")]:
        counts = [greedy(b" " + w.encode(), known) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        want.append((doc, len(counts), sum(counts), max(counts, default=0)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert wordpiece.token_counts(df.limit(0), VOCABULARY).count() == 0


def test_long_words_take_linear_time():
    rng = random.Random(2)
    automaton = wordpiece.Automaton(PIECES)
    one = bytes(rng.choices(b"abcdefghij/=", k=1_000_000))
    words = [b"the", one, b"x" * 300_000, one[:100_000]] + [bytes(rng.choices(b"abcde", k=n)) for n in range(1, 80)]
    begin = time.perf_counter()
    got = lengths(automaton, words, 0x20)
    assert time.perf_counter() - begin < 10
    known = set(PIECES)
    assert got[0] == greedy(b" the", known) and got[3:] == [greedy(b" " + w, known) for w in words[3:]]
    assert got[1] > 9 * got[3]
