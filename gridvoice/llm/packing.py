"""Pattern packing of token pieces into sequences of a fixed length.

1. Documents become token ids (an end id is added) and are cut into pieces only where they are longer than a sequence.
2. The number of pieces of each length, at most ``capacity`` numbers, goes to the driver.
3. There patterns of two to four lengths that fill a sequence exactly are listed, repeat counts are fitted to the
   histogram by non-negative least squares and rounded down, and what is left is packed by best fit, also by counts.
4. Pieces of one length are numbered across tasks and looked up in the plan: number -> sequence and offset.

The plan's size depends on the number of different lengths, not on the number of documents.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridvoice.llm.common import kept, slices, small_batches, worker_copy
from gridvoice.llm.word_tokens import Encoder

CAPACITY = 2048
END_ID = 0
#: Pieces of one length that are numbered by one task.
RUN = 512
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

def _encoder(vocabulary: str) -> Encoder:
    """The worker's encoder; it remembers words from task to task."""
    return worker_copy(("encoder", vocabulary), lambda: Encoder(vocabulary, as_library=True))


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: token pieces of whole documents, at most ``capacity`` ids each.

    ``vocabulary`` is the content of a tokenizer file. A null or empty text has the end id only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text").to_pylist())
                rows = []
                for k, doc in enumerate(part.column("id").to_pylist()):
                    own = np.append(ids[offsets[k] : offsets[k + 1]], np.uint32(END_ID)).astype("<u4")
                    for n, at in enumerate(range(0, len(own), capacity)):
                        piece = own[at : at + capacity]
                        rows.append((doc, n, at, len(piece), zlib.crc32(piece.tobytes())))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(plain).mapInArrow(run, PIECES)


def exact_patterns(counts: np.ndarray, capacity: int, partners: int = 12) -> np.ndarray:
    """Patterns of two, three and four lengths that add up to ``capacity``, one per row, padded with zeros.

    The first length is any, the last is what is missing; those between are quantiles of the lengths.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return np.empty((0, 4), np.int64)
    share = np.cumsum(counts[lengths]) / counts.sum()
    middle = np.unique(lengths[np.searchsorted(share, (np.arange(partners) + 0.5) / partners).clip(0, len(lengths) - 1)])
    found = []
    for between in [(0, 0)] + [(0, m) for m in middle] + [(m, k) for m in middle for k in middle if m <= k]:
        last = capacity - lengths - sum(between)
        fits = (last > 0) & (last <= lengths)
        fits[fits] &= counts[last[fits]] > 0
        a = lengths[fits]
        found.append(np.column_stack([a, np.full(len(a), between[1]), np.full(len(a), between[0]), last[fits]]))
    ordered = np.sort(np.concatenate(found), axis=1)[:, ::-1]
    return np.unique(ordered, axis=0)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ``|A x - counts|``, by accelerated projected gradients.

    Column p of A holds how often pattern p uses each length.
    """
    n = len(patterns)
    if not n:
        return np.empty(0)
    size = len(counts)
    used = patterns > 0

    def forward(x):
        return np.bincount(patterns[used], np.broadcast_to(x[:, None], patterns.shape)[used], size)

    def backward(r):
        return np.where(used, r[patterns], 0.0).sum(axis=1)

    # the largest eigenvalue of A'A by power iteration
    v = np.ones(n)
    for _ in range(20):
        v = backward(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1.0 / (norm * 1.05)
    x, y, t = np.zeros(n), np.zeros(n), 1.0
    target = counts.astype(float)
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * backward(forward(y) - target))
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / following * (new - x)
        x, t = new, following
    return x


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on numbers of pieces: ``(lengths, repeats)``; equal bins are one entry."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    room: list[int] = []
    plan = []

    def put(pattern: tuple[int, ...], left: int, repeats: int) -> None:
        if not left:
            plan.append((pattern, repeats))
            return
        if left not in open_bins:
            open_bins[left] = []
            bisect.insort(room, left)
        open_bins[left].append((pattern, repeats))

    for length in np.flatnonzero(counts)[::-1].tolist():
        todo = int(counts[length])
        while todo:
            at = bisect.bisect_left(room, length)
            if at == len(room):
                each = capacity // length
                for repeats, filled in ((todo // each, each), (int(todo % each > 0), todo % each)):
                    if repeats:
                        put((length,) * filled, capacity - length * filled, repeats)
                break
            left = room[at]
            pattern, repeats = open_bins[left].pop()
            if not open_bins[left]:
                del open_bins[left]
                room.pop(at)
            taken = min(todo, repeats)
            if taken < repeats:
                put(pattern, left, repeats - taken)
            put(pattern + (length,), left - length, taken)
            todo -= taken
    return plan + [entry for entries in open_bins.values() for entry in entries]


def plan_of(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """All pieces, given by their number per length, in ``(lengths of a sequence, repeats)``."""
    left = counts.astype(np.int64).copy()
    plan = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    candidates = exact_patterns(left, capacity)
    wanted = np.floor(fit(candidates, left) + 1e-9).astype(np.int64)
    # the fitted repeats first, then whatever whole pattern is still there; the rest by best fit
    for repeats in (wanted, np.full(len(candidates), np.iinfo(np.int64).max)):
        for p in np.argsort(-repeats, kind="stable"):
            if not repeats[p]:
                break
            pattern = tuple(int(x) for x in candidates[p] if x)
            taken = int(min(repeats[p], min(left[x] // pattern.count(x) for x in pattern)))
            if taken:
                for x in pattern:
                    left[x] -= taken
                plan.append((pattern, taken))
    return plan + best_fit(left, capacity)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Per slot of the plan, ordered by length and number: key (length, first number), first sequence, offset."""
    rows, following, sequence = [], {}, 0
    for pattern, repeats in plan:
        offset = 0
        for length in pattern:
            at = following.get(length, 0)
            rows.append(((length << 40) + at, sequence, offset))
            following[length] = at + repeats
            offset += length
        sequence += repeats
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces ``(doc_id, piece, length, …)`` no longer than ``capacity``.

    Every piece has one place; the places of a sequence follow each other without gaps. Rows that repeat a key are pieces of
    their own. An empty table gives an empty table.
    """
    cut = kept(cut, "pieces")
    spark = cut.sparkSession
    most = cut.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    runs = max(1, -(-most // RUN))
    numbered = cut.withColumn("run", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(runs)).cast("int"))
    counted = kept(numbered.groupBy("length", "run").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[row["length"]] = row["n"]
    shared = spark.sparkContext.broadcast(_slots(plan_of(histogram, capacity)))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("run")) - F.col("n")
    within = F.row_number().over(Window.partitionBy("length", "run").orderBy("doc_id", "piece")) - 1
    placed = (
        numbered.withColumn("within", within)
        .join(counted.select("length", "run", before.alias("before")), ["length", "run"])
        .withColumn("number", F.col("before") + F.col("within"))
        .drop("run", "within", "before")
    )
    names = [c for c in placed.columns if c != "number"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields if f.name != "number")

    def run(batches):
        keys, sequences, offsets = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            key = (batch.column("length").to_numpy() << 40) + batch.column("number").to_numpy()
            slot = np.searchsorted(keys, key, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequences[slot] + key - keys[slot]), pa.array(offsets[slot])],
                names=[*names, "sequence_id", "offset"],
            )

    return placed.mapInArrow(run, f"{schema}, sequence_id long, offset long").select(
        *cut.columns, "sequence_id", "offset"
    )
