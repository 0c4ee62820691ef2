"""Toxic passages by maximum-scoring segments of token log-odds.

1. The log-odds of a token between toxic and other labelled training texts, under a Dirichlet prior from the counts
   of all documents, and its variance give a z-value. A text counts each of its tokens once, so a token repeated
   in one text proves little. Tokens with a significant value score their log-odds, every other token costs a little, so
   that a text without toxic tokens has a falling score.
2. A linear scan finds all maximal segments: disjoint passages none of which can be made longer or shorter with a higher score.
3. Under chance, the best segment of n tokens follows an extreme-value law. Its decay solves
   sum p exp(decay * score) = 1 over the tokens of the non-toxic training texts; a segment
   of score s is expected E = K n exp(-decay s) times, so the chance of any is 1 - exp(-E). A document's evidence
   is minus the logarithm of that chance, summed over its segments with E < 1, or of its best one if there are none.
   The decay is found on the scores in bins of a thousandth, which bounds what the driver holds.
4. A logistic curve on the evidence, fitted on training labels, gives a score from 0 to 1.

The scores of tokens are counted, and sent to the tasks within the bound of a broadcast. Beyond it each text gets those of its own tokens by a join.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.llm import common
from gridvoice.llm import shingles as S
from gridvoice.llm.common import broadcast_within, kept, slices, small_batches

#: Bytes of a token and its score in the table that is sent to the tasks.
ROW_BYTES = 24
#: Scores per unit that the law of chance tells apart.
STEPS = 1000

#: A token is a run of ASCII letters and digits and of bytes above ASCII.
SEPARATOR = np.array([c < 0x80 and not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A) for c in range(256)])


@dataclass(frozen=True)
class Settings:
    """Weight of the prior as a share of the toxic counts, least z-value of a scored token, cost of any other token, folds."""

    prior: float = 1.0
    z: float = 3.0
    cost: float = 0.1
    folds: int = 5
    bins: int = 400


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for rows whose id, as text, has a checksum divisible by ``folds``; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _tokens(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row, and the first token of each text."""
    raw, offsets = S.text_bytes(piece.column("text"))
    raw = S.lowered(raw)
    starts, ends, first = S.words(raw, offsets, SEPARATOR)
    return S.word_hashes(raw, starts, ends), first


def token_counts(rows: DataFrame) -> DataFrame:
    """``(token, n, other, toxic)`` of ``rows(text, toxic)``: how many of all texts, of training texts labelled 0 and 1 have it.

    Tasks sum the counts of a slice before the shuffle.
    """

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", 8 << 20):
                hashes, first = _tokens(piece)
                label = piece.column("toxic").to_numpy(zero_copy_only=False).astype(float)
                rows_ = len(label)
                text = np.repeat(np.arange(rows_), np.diff(first))
                distinct, which = np.unique(hashes, return_inverse=True)
                once = np.unique(which * rows_ + text)
                which, own = once // max(rows_, 1), np.where(np.isnan(label), -1, label)[once % max(rows_, 1)]
                columns = [
                    np.bincount(which, weights, len(distinct)).astype(np.int64) for weights in (None, own == 0, own == 1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), *(pa.array(c) for c in columns)],
                    names=["token", "n", "other", "toxic"],
                )

    counted = small_batches(rows.select("text", F.col("toxic").cast("double").alias("toxic"))).mapInArrow(
        run, "token long, n long, other long, toxic long"
    )
    return counted.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("n", "other", "toxic")])


def log_odds(counts: DataFrame, settings: Settings) -> DataFrame:
    """``(token, weight, other, toxic)`` of significant tokens, by log-odds with a Dirichlet prior."""
    total = counts.agg(F.sum("n"), F.sum("other"), F.sum("toxic")).first()
    n, other, toxic = (float(x or 0) for x in total)
    if not other or not toxic:
        return counts.select("token", F.lit(0.0).alias("weight"), "other", "toxic").limit(0)
    whole = settings.prior * toxic
    prior = F.col("n") * (whole / n)
    a, b = F.col("toxic") + prior, F.col("other") + prior
    weight = F.log(a / (toxic + whole - a)) - F.log(b / (other + whole - b))
    z = weight / F.sqrt(1 / a + 1 / b)
    return (
        counts.filter("toxic > 0 OR other > 0")
        .withColumn("weight", weight)
        .withColumn("z", z)
        .filter(F.abs("z") >= settings.z)
        .select("token", "weight", "other", "toxic")
    )


def decay_of(weights: np.ndarray, probabilities: np.ndarray) -> float:
    """The positive root of sum p exp(decay * weight) = 1; the mean weight must be negative."""
    low, high = 0.0, 1.0
    value = lambda x: float(np.sum(probabilities * np.exp(np.minimum(x * weights, 700)))) - 1
    while value(high) < 0:
        high *= 2
        if high > 1e6:
            return high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def segments(at: np.ndarray, gain: np.ndarray, level: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in linear time.

    ``at`` are the positions of tokens with a positive score, ``gain`` their scores, ``level`` the total score before each of them. Each
    segment is ``(first token, last token, score)``.
    """
    found: list[list[float]] = []  # first, last, total before, total after, previous with a lower start
    for position, score, before in zip(at.tolist(), gain.tolist(), level.tolist()):
        left, after, begin = before, before + score, position
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = int(found[j][4])
            if j < 0 or found[j][3] >= after:
                found.append([begin, position, left, after, j])
                break
            # a piece before it starts lower and ends lower: join them and all between
            begin, left, j_before = int(found[j][0]), found[j][2], int(found[j][4])
            del found[j:]
            j = j_before
    return [(int(a), int(b), after - left) for a, b, left, after, _ in found]


def _surprise(log_expected: float) -> float:
    """Minus the logarithm of the chance of at least one, if exp(log_expected) are expected."""
    if log_expected < -30:
        return -log_expected
    chance = -math.expm1(-math.exp(min(log_expected, 30)))
    return -math.log(chance) + 0.0


def with_own_scores(docs: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``tokens`` and ``weights``, the scored tokens of the text of each row of ``docs(doc_id, text, …)``, in order of the token.

    A text brings each of its tokens once, so a row holds no more than its vocabulary.
    """

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, first = _tokens(piece)
                text = np.repeat(np.arange(piece.num_rows), np.diff(first))
                _, own = np.unique(np.rec.fromarrays([text, hashes]), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("text_hash").take(pa.array(text[own])), pa.array(hashes[own].view(np.int64))],
                    names=["text_hash", "token"],
                )

    hashed = F.xxhash64("text")
    texts = small_batches(docs.filter("text IS NOT NULL").select(hashed.alias("text_hash"), "text"))
    scored = (
        texts.mapInArrow(run, "text_hash long, token long")
        .distinct()
        .join(table.select("token", "weight"), "token")
        .groupBy("text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("token", "weight"))).alias("own"))
        .select("text_hash", F.col("own.token").alias("tokens"), F.col("own.weight").alias("weights"))
    )
    return docs.withColumn("text_hash", hashed).join(scored, "text_hash", "left").drop("text_hash")


def passages(docs: DataFrame, shared, settings: Settings) -> DataFrame:
    """Adds ``n_tokens``, ``evidence`` and ``passages (first, last, score)`` to rows with ``text``, which is dropped.

    ``shared`` is a broadcast of tokens in order, their scores, decay and factor of the law; without tokens, rows bring ``tokens``
    and ``weights`` of their own, which are dropped.
    """
    rest = [f for f in docs.schema.fields if f.name not in ("text", "tokens", "weights")]

    def value_of(piece: pa.RecordBatch, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        _, tokens, weights, _, _ = shared.value
        value = np.full(len(hashes), -settings.cost)
        parts = [(0, len(hashes), tokens, weights)]
        if tokens is None:
            own = zip(first, first[1:], piece.column("tokens"), piece.column("weights"))
            parts = [
                (a, b, np.sort(np.array(t.as_py(), np.int64).view(np.uint64)), _in_order(t.as_py(), w.as_py()))
                for a, b, t, w in own
                if t.is_valid
            ]
        for a, b, known, scores in parts:
            if len(known):
                where = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                value[a:b] = np.where(known[where] == hashes[a:b], scores[where], value[a:b])
        return value

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    schema += ", n_tokens long, evidence double, passages array<struct<first:int,last:int,score:double>>"
    inner = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        _, _, _, decay, k = shared.value
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, first = _tokens(piece)
                value = value_of(piece, hashes, first)
                level = np.concatenate([[0.0], np.cumsum(value)])
                hits = np.flatnonzero(value > 0)
                bounds = np.searchsorted(hits, first)
                evidence, found = [], []
                for d in range(piece.num_rows):
                    own = hits[bounds[d] : bounds[d + 1]]
                    n = int(first[d + 1] - first[d])
                    all_of = segments(own - first[d], value[own], level[own] - level[first[d]]) if len(own) else []
                    limit = math.log(max(k * n, 1e-9))
                    significant = [s for s in all_of if decay * s[2] > limit]
                    counted = significant or sorted(all_of, key=lambda s: s[2])[-1:]
                    evidence.append(sum(_surprise(limit - decay * s[2]) for s in counted))
                    found.append([{"first": a, "last": b, "score": s} for a, b, s in significant])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(f.name) for f in rest),
                        pa.array(np.diff(first)),
                        pa.array(evidence, pa.float64()),
                        pa.array(found, inner),
                    ],
                    names=[*(f.name for f in rest), "n_tokens", "evidence", "passages"],
                )

    return small_batches(docs).mapInArrow(run, schema)


def _in_order(tokens: list[int], weights: list[float]) -> np.ndarray:
    """The scores in the order of the tokens as unsigned numbers."""
    return np.array(weights)[np.argsort(np.array(tokens, np.int64).view(np.uint64))]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not negative) of a weighted logistic regression, by Newton's method with a small ridge."""
    a, b = 0.0, 1.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([np.sum(weight * (p - y)) + 1e-3 * a, np.sum(weight * (p - y) * x) + 1e-3 * b])
        h = weight * p * (1 - p)
        hess = np.array([[h.sum() + 1e-3, (h * x).sum()], [(h * x).sum(), (h * x * x).sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), max(float(b), 0.0)


def score(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted, n_tokens, evidence, passages``.

    Learns from labelled rows that are not held out: ``toxic`` of ``labels``; labels that repeat an id count as the largest.
    Null and empty texts have no passages and score like other texts without evidence. Without labels of both
    kinds every score is 0. Rows that repeat an id are each scored on their own text. Other columns are ignored.
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    known = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("_labelled"), settings.folds))
    )
    known = broadcast_within(known, known.count(), 40)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        known, F.col("doc_id") == F.col("_labelled"), "left"
    )
    counts = kept(token_counts(rows), "tokens")
    totals = counts.agg(F.sum("other")).first()[0] or 0
    scores = kept(log_odds(counts, settings), "scores")
    # at most ``STEPS`` numbers per unit of a score go to the driver
    steps = (
        scores.groupBy(F.round(F.col("weight") * STEPS).alias("step"))
        .agg(F.sum("other").alias("other"), F.sum("weight").alias("sum"), F.count(F.lit(1)).alias("n"))
        .toArrow()
    )
    mean = steps.column("sum").to_numpy() / np.maximum(steps.column("n").to_numpy(), 1)
    decay, k = _law(mean, steps.column("other").to_numpy() / max(totals, 1), settings)
    texts = rows.select("doc_id", F.col("toxic").cast("int").alias("label"), "text")
    hashes = weights = None
    if scores.count() * ROW_BYTES <= common.BROADCAST_BYTES:
        table = scores.select("token", "weight").toArrow()
        hashes = table.column("token").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes, weights = hashes[order], table.column("weight").to_numpy()[order]
    else:
        texts = with_own_scores(texts, scores)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, hashes, weights, decay, k))

    found = kept(passages(texts, shared, settings), "passages")
    # at most ``bins`` numbers per label go to the driver
    binned = (
        found.filter("label IS NOT NULL")
        .groupBy("label", F.least(F.floor(F.sqrt("evidence") * 20), F.lit(settings.bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    y = np.array([float(r["label"]) for r in binned])
    if len(set(y)) < 2:
        probability = F.lit(0.0)
    else:
        x = np.array([r["bin"] / 20 for r in binned])
        intercept, slope = logistic(x, y, np.array([float(r["n"]) for r in binned]))
        # the bins are for the fit; every text is scored on its own evidence
        probability = 1 / (1 + F.exp(-(intercept + slope * F.sqrt("evidence"))))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), settings.folds).alias("held_out"),
        probability.cast("double").alias("score"),
        (probability >= 0.5).cast("int").alias("predicted"),
        "n_tokens",
        "evidence",
        "passages",
    )


def _law(weights: np.ndarray, share: np.ndarray, settings: Settings) -> tuple[float, float]:
    """Decay and factor of the extreme-value law of chance segments."""
    rest = max(0.0, 1.0 - float(share.sum()))
    values, probabilities = np.append(weights, -settings.cost), np.append(share, rest)
    drift = float(np.sum(values * probabilities))
    if not len(weights) or drift >= 0 or not (weights > 0).any():
        return 1.0, 1.0
    decay = decay_of(values, probabilities)
    # chance of a new high per token: the share of tokens that can begin a segment
    return decay, max(float(share[weights > 0].sum()), 1e-9)
