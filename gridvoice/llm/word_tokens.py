"""Token ids of whole texts: each distinct word of a slice goes through the tokenizer once.

A tokenizer that splits a text into words before it merges symbols gives a word the same ids wherever it stands. So the
text is split here, with the split pattern of the vocabulary, on arrays of code points; only words that this worker has
not met go through the library. Texts with characters from U+0250 on, and those with a dotted capital I, go through
the library as they are: their normal form or lower case may differ between Unicode versions. So do texts with the string of an added token, if those
are to give its id.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from tokenizers import Tokenizer

from gridvoice.llm import shingles as S

LIMIT = 0x250
DOTTED = 0x130
#: Words a worker remembers; beyond it starts anew. It bounds memory and has no effect on results.
REMEMBERED = 400_000
SPACE, LETTER, NUMBER, MARK = 0, 1, 2, 3
#: White space below U+0250, and the endings split off after an apostrophe.
WHITE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


def _kinds() -> np.ndarray:
    kinds = np.full(LIMIT, MARK, np.uint8)
    for c in range(LIMIT):
        group = unicodedata.category(chr(c))[0]
        kinds[c] = LETTER if group == "L" else NUMBER if group == "N" else MARK
    kinds[WHITE] = SPACE
    return kinds


_KINDS = _kinds()
_LOWER = np.array([ord(chr(c).lower()) if c != DOTTED else c for c in range(LIMIT)], np.uint32)
_VALUES = S.symbol_values(int(_LOWER.max()) + 1)


class Encoder:
    """Ids of texts under one vocabulary.

    Strings of special tokens are ordinary text, or with ``as_library`` what the library's default makes of them: their ids.
    """

    def __init__(self, vocabulary: str, as_library: bool = False):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = not as_library
        added = self.tokenizer.get_added_tokens_decoder().values() if as_library else []
        self.added = [t.content for t in added]
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        counts, ids = [], []
        for begin in range(0, len(words), 4096):
            some = words[begin : begin + 4096]
            made = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            of = np.array(made.word_ids, dtype=np.int64)
            if len(of) and of[-1] + 1 == len(some):
                counts.append(np.bincount(of, minlength=len(some)))
                ids.append(np.array(made.ids, np.uint32))
            else:  # a word the library splits further
                each = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in some]
                counts.append(np.array([len(x) for x in each]))
                ids.append(np.array([y for x in each for y in x], np.uint32))
        count = np.concatenate(counts)
        at = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, *ids])
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.at, self.count = np.insert(self.at, where, at), np.insert(self.count, where, count)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the n + 1 offsets of the texts."""
        texts = [t or "" for t in texts]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        odd = (points >= LIMIT) | (points == DOTTED)
        whole = np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) > 0
        whole |= np.array([any(a in t for a in self.added) for t in texts], bool)
        strange = np.flatnonzero(whole)
        if not len(strange):
            return self._plain(points, offsets)
        usual = [t for i, t in enumerate(texts) if i not in set(strange.tolist())]
        ids, own = self.encode(usual)
        parts = [ids[a:b] for a, b in zip(own, own[1:])]
        for i in strange:
            parts.insert(i, np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32))
        sizes = np.array([len(p) for p in parts])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])

    def _plain(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(points)
        if not n:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        lowered = _LOWER[points]
        kinds = _KINDS[points]
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True
        first = first[:n]
        opens = first.copy()
        opens[1:] |= kinds[1:] != kinds[:-1]
        opens |= kinds == NUMBER
        self._endings(lowered, kinds, opens, first)
        opens &= kinds != SPACE
        closes = kinds != SPACE
        closes[:-1] &= opens[1:] | (kinds[1:] == SPACE) | first[1:]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        hashes = S.word_hashes(lowered, starts, ends, _VALUES)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            text = lowered.tobytes().decode("utf-32-le", "surrogatepass")
            self._learn(distinct[new], [text[starts[i] : ends[i]] for i in sample[new]])
            at = np.searchsorted(self.known, distinct)
        begin, size = self.at[at][which], self.count[at][which]
        upto = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]
        return ids, np.concatenate([[0], upto])[np.searchsorted(starts, offsets)]

    @staticmethod
    def _endings(lowered: np.ndarray, kinds: np.ndarray, opens: np.ndarray, first: np.ndarray) -> None:
        """An apostrophe at the start of a run of marks takes an ending of the list with it."""
        n = len(lowered)
        at = np.flatnonzero((lowered == 0x27) & opens)
        for i in at[at + 1 < n]:
            for ending in ENDINGS:
                stop = i + 1 + len(ending)
                if stop <= n and not first[i + 1 : stop].any() and all(
                    lowered[i + 1 + k] == ord(c) for k, c in enumerate(ending)
                ):
                    opens[i + 1 : stop] = False
                    if stop < n:
                        opens[stop] = True
                    break
