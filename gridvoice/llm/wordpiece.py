"""Token counts by a linear longest-match automaton.

Greedy longest match cuts a word into the longest piece of the vocabulary that it starts with, and so on. A trie of the
vocabulary with failure links does so in one pass: where no edge fits, the link leads to the node of what remains
after the longest pieces are cut off, and the number of those pieces was computed beforehand. So pieces are
counted without building them.

The automaton reads all different words of a slice at once, one symbol per step. Once few words are left, which are the long ones, they
are read one after the other by plain look-ups, so the time stays linear in the bytes.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.llm import shingles as S
from gridvoice.llm.common import slices, small_batches, worker_copy

#: Marks the beginning of a word in the vocabulary.
LEAD = 0x20
#: Words below which a step over arrays costs more than plain look-ups.
FEW = 32


def byte_vocabulary(content: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file, as bytes, without the special tokens."""
    parsed = json.loads(content)
    # the printable stand-ins of the bytes that byte-level vocabularies use
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    stands_for = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in parsed.get("added_tokens", [])}
    return [bytes(stands_for[c] for c in piece) for piece in parsed["model"]["vocab"] if piece not in special]


class Automaton:
    """Trie with failure links and popped counts; every single byte must be a piece."""

    def __init__(self, pieces: list[bytes]):
        missing = set(range(256)) - {p[0] for p in pieces if len(p) == 1}
        if missing:
            raise ValueError(f"{len(missing)} bytes are not pieces, so some words have no cut")
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    final.append(False)
                node = children[node][byte]
            final[node] = final[node] or bool(piece)
        self._link(children, final)
        edges = sorted((node << 8 | byte, child) for node, own in enumerate(children) for byte, child in own.items())
        self.edges = np.array([e for e, _ in edges], np.int64)
        self.targets = np.array([t for _, t in edges], np.int32)
        # the same in plain types, for words read one by one
        self.plain = dict(edges), self.link.tolist(), self.popped.tolist()

    def _link(self, children: list[dict[int, int]], final: list[bool]) -> None:
        """Breadth first: what is left and how many pieces are cut off if no edge fits at a node."""
        link, popped = np.zeros(len(children), np.int32), np.zeros(len(children), np.int32)
        layer = [0]
        while layer:
            below = []
            for parent in layer:
                for byte, node in children[parent].items():
                    below.append(node)
                    if final[node]:
                        popped[node] = 1
                        continue
                    at, cut = int(link[parent]), int(popped[parent])
                    while byte not in children[at]:
                        cut, at = cut + int(popped[at]), int(link[at])
                    link[node], popped[node] = children[at][byte], cut
            layer = below
        self.link, self.popped = link, popped

    def _step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Child by symbol, -1 if there is none."""
        wanted = nodes.astype(np.int64) << 8 | symbols
        at = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
        return np.where(self.edges[at] == wanted, self.targets[at], -1)

    def _read(self, node: int, symbols: bytes) -> tuple[int, int]:
        """Node and number of pieces cut off after the symbols, read one by one."""
        edges, link, popped = self.plain
        count = 0
        for symbol in symbols:
            while (target := edges.get(node << 8 | symbol)) is None:
                count += popped[node]
                node = link[node]
            node = target
        return node, count

    def lengths(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: int | None = LEAD) -> np.ndarray:
        """Number of pieces of each word ``raw[start:end]``, with ``lead`` before it."""
        count = np.zeros(len(starts), np.int64)
        node = np.zeros(len(starts), np.int32)
        order = np.argsort(starts - ends, kind="stable")  # longest first: the active words are a prefix
        size = (ends - starts)[order]
        first = starts[order]
        if lead is not None:
            node[:] = self._step(node, np.full(len(node), lead))
        for k in range(int(size[0]) if len(size) else 0):
            active = np.arange(np.searchsorted(-size, -k, "left"))
            if len(active) <= FEW:
                for word in active.tolist():
                    node[word], more = self._read(int(node[word]), raw[first[word] + k : first[word] + size[word]].tobytes())
                    count[word] += more
                break
            symbols = raw[first[active] + k].astype(np.int64)
            while len(active):
                target = self._step(node[active], symbols)
                fits = target >= 0
                node[active[fits]] = target[fits]
                active, symbols = active[~fits], symbols[~fits]
                count[active] += self.popped[node[active]]
                node[active] = self.link[node[active]]
        active = np.flatnonzero(node)
        while len(active):
            count[active] += self.popped[node[active]]
            node[active] = self.link[node[active]]
            active = active[node[active] != 0]
        out = np.empty_like(count)
        out[order] = count
        return out


def _automaton(vocabulary: str) -> Automaton:
    return worker_copy(("automaton", vocabulary), lambda: Automaton(byte_vocabulary(vocabulary)))


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, n_tokens, longest_word_tokens``.

    ``vocabulary`` is the content of a byte-level vocabulary file. A word is a run of bytes other than ASCII
    white space; it is cut with one space before it, greedily into the longest pieces. White space alone gives no tokens. Null and empty
    texts have no words and no tokens. Rows that repeat an id, or have a null one, are each counted. Other columns are
    ignored. An empty table gives an empty table. A word of any length is read in time linear in its bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        automaton = _automaton(shared.value)
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                raw, offsets = S.text_bytes(piece.column("text"))
                starts, ends, first = S.words(raw, offsets)
                hashes = S.word_hashes(raw, starts, ends)
                _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
                each = automaton.lengths(raw, starts[sample], ends[sample])[which] if len(starts) else np.zeros(0, np.int64)
                upto = np.concatenate([[0], np.cumsum(each)])[first]
                most = np.zeros(piece.num_rows, np.int64)
                filled = np.flatnonzero(np.diff(first))
                if len(filled):
                    most[filled] = np.maximum.reduceat(each, first[:-1][filled])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(np.diff(first)), pa.array(np.diff(upto)), pa.array(most)],
                    names=["doc_id", "n_words", "n_tokens", "longest_word_tokens"],
                )

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(plain).mapInArrow(run, "doc_id long, n_words long, n_tokens long, longest_word_tokens long")
