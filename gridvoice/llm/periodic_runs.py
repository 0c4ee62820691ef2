"""Periodic runs of words, found on a grammar of the text, and texts with each run cut to its first period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least ``least_words`` words and
``least_periods`` periods long, that no neighbouring word extends keeping that period.

1. Words become ids. Every window of ``WINDOW`` words inside a run occurs twice or more in the run, so runs lie in stretches of
   repeated windows, and other words are set aside. This is exact: it sets aside no word of a run.
2. Re-Pair turns each stretch into a grammar: the most frequent pair of symbols becomes a nonterminal until no pair repeats;
   of pairs that are equally frequent the oldest goes first, which keeps the grammar flat.
3. The runs that cross the boundary between the two halves of a nonterminal are computed once per nonterminal. Every run of the
   text crosses the boundary of exactly one node of the derivation tree that holds all of it.
4. They are translated to all positions where the nonterminal is derived, and intervals of one period that overlap by
   a period or more are merged.

Each text is handled by itself, in memory that is in proportion to its words.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.llm.common import slices, small_batches
from gridvoice.llm.shingles import mix

#: Windows that tell which words may lie in a run. With 24 words and three periods at least, a run has every window of up
#: to 8 words twice.
WINDOW = 8
#: Words that must agree before a period is tried at a boundary. A run of 24 words and three periods shows them at one of two places.
ANCHOR = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(int(_BASE), k, 2**64)) for k in range(WINDOW)]


@dataclass(frozen=True)
class Settings:
    """Fewest words and fewest periods of a run; at least 24 and 3, which the windows and anchors are made for."""

    least_words: int = 24
    least_periods: int = 3

    def __post_init__(self):
        if self.least_words < 24 or self.least_periods < 3:
            raise ValueError("a run has at least 24 words and three periods")


def _windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words: equal windows have equal hashes."""
    values = mix(ids.astype(np.uint64) + np.uint64(1))
    out = np.zeros(len(ids) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out += values[k : k + len(out)] * _POWERS[size - 1 - k]
    return out


def _stretches(mask: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _repeated(values: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    equal = ordered[1:] == ordered[:-1]
    out = np.zeros(len(values), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def zones(ids: np.ndarray, settings: Settings) -> Iterator[tuple[int, int]]:
    """Stretches of words outside of which there is no run.

    Windows must repeat within their stretch, so a passage that returns far away is set aside by the second round.
    """
    if len(ids) < settings.least_words:
        return
    hashes = _windows(ids, WINDOW)
    for begin, end in _stretches(_repeated(hashes)):
        if end - begin + WINDOW - 1 < settings.least_words:
            continue
        for first, last in _stretches(_repeated(hashes[begin:end])):
            if last - first + WINDOW - 1 >= settings.least_words:
                yield begin + first, begin + last + WINDOW - 1


def re_pair(text: list[int]) -> tuple[int, list[tuple[int, int]], list[int]]:
    """First nonterminal, rules in the order of their making, and the sequence that is left.

    Counts are kept as upper bounds: a pair's places are looked through when it is the most frequent by its bound.
    """
    n = len(text)
    fresh = max(text, default=-1) + 1
    symbol, after, before = list(text), list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        places.setdefault((text[i], text[i + 1]), []).append(i)
    age = 0
    heap = []
    for pair, found in places.items():
        if len(found) > 1:
            heap.append((-len(found), age, pair))
            age += 1
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        _, born, pair = heapq.heappop(heap)
        left, right = pair
        live, taken = [], -1
        for i in places.pop(pair):
            if i > taken and symbol[i] == left:
                j = after[i]
                if j < n and symbol[j] == right:
                    live.append(i)
                    taken = j
        if len(live) < 2:
            continue
        if heap and -heap[0][0] > len(live):
            places[pair] = live
            heapq.heappush(heap, (-len(live), born, pair))
            continue
        x = fresh + len(rules)
        rules.append(pair)
        made: dict[tuple[int, int], list[int]] = {}
        for i in live:
            j = after[i]
            k = after[j]
            symbol[i], symbol[j], after[i] = x, -1, k
            if k < n:
                before[k] = i
                made.setdefault((x, symbol[k]), []).append(i)
            h = before[i]
            if h >= 0:
                made.setdefault((symbol[h], x), []).append(h)
        for new, found in made.items():
            if len(found) > 1:
                places[new] = found
                heapq.heappush(heap, (-len(found), age, new))
                age += 1
    sequence, i = [], 0
    while i < n:
        sequence.append(symbol[i])
        i = after[i]
    return fresh, rules, sequence


def _prefix(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading elements agree; looks at four times as many each time, so a short match is cheap."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        unequal = x[at : at + step] != y[at : at + step]
        if unequal[: n - at].any():
            return at + int(unequal.argmax())
        at, step = at + step, step * 4
    return n


def crossing(
    text: np.ndarray, anchors: np.ndarray, begin: int, middle: int, end: int, settings: Settings
) -> list[tuple[int, int, int]]:
    """Runs ``(period, start, end)`` of ``text[begin:end]`` that hold the words on both sides of ``middle``.

    A run of period q has the windows at ``middle - 1`` and q words later, or those at ``middle + 1 - ANCHOR`` and q words earlier,
    inside it; only periods that show one of them are tried. Periods may be multiples of the smallest.
    """
    most = (end - begin) // settings.least_periods
    later, earlier = middle - 1, middle + 1 - ANCHOR
    tries = []
    last = min(most, end - ANCHOR - later)
    if last > 0:
        q = np.flatnonzero(anchors[later + 1 : later + 1 + last] == anchors[later]) + 1
        tries.append(np.stack([q, np.full(len(q), later)]))
    last = min(most, earlier - begin)
    if last > 0:
        q = np.flatnonzero(anchors[earlier - last : earlier][::-1] == anchors[earlier]) + 1
        tries.append(np.stack([q, earlier - q]))
    if not tries:
        return []
    tries = np.concatenate(tries, axis=1)
    tries = tries[:, np.argsort(tries[0], kind="stable")]
    found = []
    while tries.shape[1]:
        q, i = int(tries[0, 0]), int(tries[1, 0])
        tries = tries[:, 1:]
        right = _prefix(text[i : end - q], text[i + q : end])
        if not right:
            continue
        left = _prefix(text[begin:i][::-1], text[begin + q : i + q][::-1])
        start, stop = i - left, i + right + q
        length = stop - start
        if length < max(settings.least_words, settings.least_periods * q) or not start < middle < stop:
            continue
        found.append((q, start, stop))
        # inside this run, a multiple of its period gives the same run again
        again = (tries[0] % q == 0) & (tries[0] + q <= length)
        again &= (tries[1] >= start) & (tries[1] + tries[0] + ANCHOR <= stop)
        tries = tries[:, ~again]
    return found


def zone_runs(text: np.ndarray, settings: Settings) -> np.ndarray:
    """All runs of a stretch: rows of start, end and smallest period."""
    _, dense = np.unique(text, return_inverse=True)
    fresh, rules, sequence = re_pair(dense.tolist())
    rules = list(rules)
    # the sequence left over becomes a balanced tree, whose nodes occur once
    while len(sequence) > 1:
        above = []
        for k in range(0, len(sequence) - 1, 2):
            above.append(fresh + len(rules))
            rules.append((sequence[k], sequence[k + 1]))
        sequence = above + sequence[len(sequence) & ~1 :]
    lengths = [1] * fresh
    for left, right in rules:
        lengths.append(lengths[left] + lengths[right])
    anchors = _windows(dense, ANCHOR)
    derived: dict[int, list[np.ndarray]] = {sequence[0]: [np.zeros(1, np.int64)]}
    periods, starts, ends = [], [], []
    for x in range(fresh + len(rules) - 1, fresh - 1, -1):
        if lengths[x] < settings.least_words:
            continue
        positions = derived.pop(x)
        positions = positions[0] if len(positions) == 1 else np.concatenate(positions)
        left, right = rules[x - fresh]
        middle = lengths[left]
        first = int(positions[0])
        for q, start, stop in crossing(dense, anchors, first, first + middle, first + lengths[x], settings):
            periods.append(np.full(len(positions), q))
            starts.append(positions + (start - first))
            ends.append(positions + (stop - first))
        for part, shift in ((left, 0), (right, middle)):
            if lengths[part] >= settings.least_words:
                derived.setdefault(part, []).append(positions + shift)
    if not periods:
        return np.empty((0, 3), np.int64)
    return merged(np.concatenate(periods), np.concatenate(starts), np.concatenate(ends))


def merged(period: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Intervals of one period that overlap by it or more become one; of equal intervals the smallest period stays."""
    order = np.lexsort((start, period))
    period, start, end = period[order], start[order], end[order]
    reach = end + period * (int(end.max()) + 1)  # never falls below that of a smaller period
    reach = np.maximum.accumulate(reach) - period * (int(end.max()) + 1)
    new = np.ones(len(period), bool)
    new[1:] = (period[1:] != period[:-1]) | (reach[:-1] - start[1:] < period[1:])
    at = np.flatnonzero(new)
    rows = np.stack([start[at], np.maximum.reduceat(end, at), period[at]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = np.zeros(len(rows), bool)
    same[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    return rows[~same]


def word_runs(words: list, settings: Settings = Settings()) -> np.ndarray:
    """Runs of a list of words: rows of start, end and smallest period, by start and period."""
    numbers = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    found = [zone_runs(ids[begin:end], settings) + [begin, begin, 0] for begin, end in zones(ids, settings)]
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, stays in zip(words, keep.tolist()) if stays])


RUNS = "runs array<struct<start: long, length: long, period: long>>, text_collapsed string"


def periodic_runs(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, text_collapsed``; runs are ordered by start, then period.

    Words are runs of characters other than ASCII white space, told apart by their bytes. Null, empty and blank texts have no words, no
    runs and an empty collapsed text. Rows are handled one by one, so repeated ids, repeated rows and null ids stay as they are. Texts of
    any length are read whole, by one task each. Runs of one start are ordered by period, so there are no ties. Other columns are
    ignored, whatever their names. An empty table gives an empty table.
    """

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for piece in slices(batch, "text"):
                counts, runs, texts = [], [], []
                for text in piece.column("text").cast(pa.large_binary()).to_pylist():
                    words = (text or b"").split()
                    found = word_runs(words, settings)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": e - s, "period": q} for s, e, q in found.tolist()])
                    texts.append(collapsed(words, found))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, kind),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "text_collapsed"],
                )

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(plain).mapInArrow(run, f"doc_id long, n_words long, {RUNS}")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents of which a tenth, chosen by the checksum of the id, ends in a periodic run; in built-in functions.

    With h the CRC-32 of the decimal id and g = h div 10: if h mod 10 is 0, word i >= a becomes word a + (i - a) mod p, where
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Such a text has its words joined by one space. Texts without words and rows with
    a null id stay as they are.
    """
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(held):
        column, n = held["words"], F.size(held["words"]).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
        # head and root are cut out and the root is repeated, so no word is looked up by its number
        root = F.slice(column, (a + 1).cast("int"), p.cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(root, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
        return F.array_join(F.concat(F.slice(column, F.lit(1), a.cast("int")), tail), " ")

    # a one-element array binds the words, so they are split once
    changed = F.transform(F.array(F.struct(words.alias("words"))), lambda held: F.when(F.size(held["words"]) > 0, planted(held)))
    chosen = h % 10 == 0
    return docs.withColumn(
        text_col, F.when(chosen, F.coalesce(F.element_at(changed, 1), F.col(text_col))).otherwise(F.col(text_col))
    )
