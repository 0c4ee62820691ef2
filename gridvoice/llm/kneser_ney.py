"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

* Every character is a symbol of its own, and so is the start of a text; an n-gram is the code points of four symbols, four
  bytes each. The model holds all n-grams of the trusted text, so it grows with it.
* Tasks count the n-grams of trusted text; their partial counts are summed by n-gram.
* Count tables of each order are joined with their context totals and with the probabilities of the next lower order.
* The joined probabilities are sent to the tasks as long as they are within the bound of a broadcast. Beyond it the n-grams of slices of
  documents, each once a slice, are joined with them by shuffling, and the answers with their slice. Both give the same.
* A document is rejected if its perplexity is above a quantile of the trusted documents of its language. There each trusted text is
  measured by a model that has not seen it: the trusted texts are dealt into folds by their hash, and besides the model of all there is
  one without each fold, whose counts are all counts less those of the fold. All models are made by the same jobs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.llm import common
from gridvoice.llm import shingles as S
from gridvoice.llm.common import broadcast_within, kept, slices, small_batches, worker_copy

ORDER = 4
#: Symbols among which the probability of an unseen one is shared out, at least.
CLASSES = 64
#: No character has this code.
START = 0x110000
CODE = 4
LEAST_DISCOUNT = 0.05
#: The model of all trusted texts; model k is that without fold k.
WHOLE = -1
#: Bytes of text whose n-grams are asked for together where the models are joined.
SLICE_BYTES = 8 << 20
#: Bytes of an n-gram or context of a model that is sent to the tasks.
ROW_BYTES = 48


@dataclass(frozen=True)
class Settings:
    """Quantile of the trusted documents that is still accepted, and the margin above it, as a factor.

    The mean over few characters scatters: below ``settled`` characters the threshold grows by the factor
    ``exp(scatter * (1 / sqrt(n) - 1 / sqrt(settled)))``.
    """

    quantile: float = 0.99
    margin: float = 1.05
    settled: int = 256
    scatter: float = 4.5
    #: Bins of the logarithm of the perplexity for the quantile, per unit.
    bins: int = 1000
    #: Parts of the trusted texts, each measured by a model of the others.
    folds: int = 4


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    return np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32), sizes


def _grams(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each character, a row of symbols; texts begin with start marks."""
    lead = ORDER - 1
    padded = np.full(len(points) + lead * len(sizes), START, np.uint32)
    at = np.arange(len(points)) + lead * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    padded[at] = points
    return np.stack([padded[at - back] for back in range(lead, -1, -1)], axis=1)


def _hashes(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of symbols."""
    out = np.zeros(len(grams), np.uint64)
    with np.errstate(over="ignore"):
        for column in grams.T:
            out = S.mix(out + column.astype(np.uint64) + np.uint64(1))
    return out


def _binary(grams: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(grams, "<u4")
    width = CODE * grams.shape[1]
    return pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _symbols(grams: pa.ChunkedArray, order: int) -> np.ndarray:
    """The rows of symbols of n-grams of one order, without an object for each of them."""
    parts = [np.zeros((0, order), np.uint32)]
    for chunk in grams.cast(pa.large_binary()).chunks:
        _, offsets, data = chunk.buffers()
        if len(chunk) and data is not None:
            ends = np.frombuffer(offsets, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
            raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
            parts.append(np.frombuffer(raw.tobytes(), "<u4").reshape(len(chunk), order))
        else:
            parts.append(np.zeros((len(chunk), order), np.uint32))
    return np.concatenate(parts)


def gram_counts(trusted: DataFrame) -> DataFrame:
    """``(model, gram, n)`` over all trusted texts, and over those outside of each fold if there is a column ``fold``.

    Each task sums the n-grams of a slice before the shuffle.
    """
    folded = "fold" in trusted.columns

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                points, sizes = _code_points(piece.column("text").to_pylist())
                grams = _grams(points, sizes)
                hashes, of = _hashes(grams), np.repeat(piece.column("fold").to_numpy(), sizes)
                for fold in np.unique(of):
                    own = np.flatnonzero(of == fold)
                    _, first, n = np.unique(hashes[own], return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), fold), pa.int32()), _binary(grams[own[first]]), pa.array(n, pa.int64())],
                        names=["fold", "gram", "n"],
                    )

    fold = F.col("fold").cast("int") if folded else F.lit(WHOLE)
    parts = small_batches(trusted.select("text", F.coalesce(fold, F.lit(WHOLE)).alias("fold"))).mapInArrow(
        run, "fold int, gram binary, n long"
    )
    folds = [r[0] for r in trusted.select("fold").distinct().collect() if r[0] is not None] if folded else []
    if len(folds) < 2:  # without the only fold nothing is left
        folds = []
    without = [F.sum(F.when(F.col("fold") != k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in folds]
    models = [F.struct(F.lit(WHOLE).alias("model"), F.col("n")), *(F.struct(F.lit(k).alias("model"), F.col(f"n{k}").alias("n")) for k in folds)]
    return (
        parts.groupBy("gram")
        .agg(F.sum("n").alias("n"), *without)
        .select("gram", F.explode(F.array(*models)).alias("m"))
        .select("m.model", "gram", "m.n")
        .filter("n > 0")
    )


def _rest(gram: Column, order: int) -> Column:
    """Without the first symbol."""
    return F.substring(gram, CODE + 1, CODE * (order - 1))


def _context(gram: Column, order: int) -> Column:
    """Without the last symbol."""
    return F.substring(gram, 1, CODE * (order - 1))


def _of_model(values: dict[int, float], column: str = "model") -> Column:
    """The value of a row's model."""
    found = F.lit(None).cast("double")
    for model, value in values.items():
        found = F.when(F.col(column) == model, F.lit(float(value))).otherwise(found)
    return found


def model(counts: DataFrame) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """Interpolated modified Kneser-Ney, for all models of ``counts`` at once.

    ``(model, order, gram, p)`` for the n-grams seen, ``(model, order, context, backoff)``, and the number of symbols of each model. The highest
    order uses counts, the lower ones the number of different characters before. A discount that the counts of counts do not give is a
    small one, so that unseen characters keep some probability.
    """
    by_order = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        # dropping the first character: what is left once for each of its predecessors
        rest = _rest(F.col("gram"), order + 1)
        by_order[order] = by_order[order + 1].groupBy("model", rest.alias("gram")).agg(F.count(F.lit(1)).alias("n"))

    # all that were seen, the start and an unseen one
    symbols = {WHOLE: CLASSES} | {r["model"]: max(CLASSES, r["count"] + 2) for r in by_order[1].groupBy("model").count().collect()}
    lower, probabilities, backoffs = None, [], []
    for order in range(1, ORDER + 1):
        grams = by_order[order].withColumn("context", _context(F.col("gram"), order))
        # a row per model
        seen_times = grams.groupBy("model").agg(*[F.sum((F.col("n") == k).cast("int")) for k in (1, 2, 3, 4)]).collect()
        discounts: list[dict[int, float]] = [{}, {}, {}]
        for own_model, *times in seen_times:
            n1, n2, n3, n4 = map(float, times)
            y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
            steps = [k - (k + 1) * y * b / a if a else 0.0 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            for k, d in enumerate(steps, 1):
                discounts[k - 1][own_model] = min(max(d, LEAST_DISCOUNT), k * 0.95)
        d1, d2, d3 = map(_of_model, discounts)
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        grams = grams.withColumn("discount", F.least(discount, F.col("n")))
        totals = grams.groupBy("model", "context").agg(
            F.sum("n").alias("total"), (F.sum("discount") / F.sum("n")).alias("backoff")
        )
        joined = grams.join(totals, ["model", "context"])
        own = (F.col("n") - F.col("discount")) / F.col("total")
        if lower is None:
            seen = joined.select("model", "gram", (own + F.col("backoff") / _of_model(symbols)).alias("p"))
        else:
            seen = (
                joined.withColumn("rest", _rest(F.col("gram"), order))
                .join(lower.select("model", F.col("gram").alias("rest"), F.col("p").alias("lower")), ["model", "rest"])
                .select("model", "gram", (own + F.col("backoff") * F.col("lower")).alias("p"))
            )
        lower = kept(seen, f"order{order}")
        probabilities.append(lower.select("model", F.lit(order).alias("order"), "gram", "p"))
        backoffs.append(totals.select("model", F.lit(order).alias("order"), "context", "backoff"))
    union = DataFrame.unionByName
    p, b = probabilities[0], backoffs[0]
    for more_p, more_b in zip(probabilities[1:], backoffs[1:]):
        p, b = union(p, more_p), union(b, more_b)
    return p, b, symbols


class Lookup:
    """Probabilities of n-grams, seen or not, under a gathered model."""

    def __init__(self, symbols: int, p: list, backoff: list):
        self.symbols = symbols
        self.p, self.backoff = ([self._sorted(*t) for t in tables] for tables in (p, backoff))

    @staticmethod
    def _sorted(grams: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = _hashes(grams)
        order = np.argsort(hashes)
        return hashes[order], values[order]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each row, and whether there is one."""
        keys, values = table
        if not len(keys):
            return np.zeros(len(grams)), np.zeros(len(grams), bool)
        hashes = _hashes(grams)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return values[at], keys[at] == hashes

    def logs(self, grams: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of the last symbol of each row after the others."""
        out = np.ones(len(grams))
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            some = grams[left, ORDER - order :]
            value, seen = self._find(self.p[order - 1], some)
            out[left[seen]] *= value[seen]
            left, some = left[~seen], some[~seen]
            weight, known = self._find(self.backoff[order - 1], some[:, :-1])
            out[left] *= np.where(known, weight, 1.0)
        out[left] /= self.symbols
        return np.log(out)


def table(p: list[tuple[np.ndarray, np.ndarray]], backoff: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Logarithms for every symbol after every context of the highest order that was seen, context by context."""
    seen = p[0][0][:, 0]
    symbols = max(CLASSES, len(seen) + 2)
    # codes above the start stand for symbols that were not seen
    after = np.concatenate([seen, START + 1 + np.arange(symbols - len(seen), dtype=np.uint32)]).astype(np.uint32)
    contexts = backoff[ORDER - 1][0]
    grams = np.column_stack([np.repeat(contexts, symbols, axis=0), np.tile(after, len(contexts))])
    return Lookup(symbols, p, backoff).logs(grams)


def _lookup(shared) -> dict[int, Lookup]:
    """The look-up tables of broadcast models, built once per Python worker."""
    key, models = shared.value
    return worker_copy(key, lambda: {k: Lookup(*tables) for k, tables in models.items()})


@dataclass(frozen=True)
class Sharded:
    """Models beyond the bound of a broadcast: the tables of ``model``, and the number of symbols of each."""

    p: DataFrame
    backoff: DataFrame
    symbols: dict[int, int]


def _means(values: np.ndarray, sizes: np.ndarray, there: np.ndarray) -> pa.Array:
    """Perplexity of each text that is there; ``values`` are those of its characters, one text after the other."""
    total, sizes = np.zeros(len(sizes)), np.where(there, sizes, 0)
    filled = np.flatnonzero(sizes)
    if len(filled):
        total[filled] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[filled])
    return pa.array(np.exp(-total / np.maximum(sizes, 1)), mask=sizes == 0)


def _folds(column: pa.Array | pa.ChunkedArray, models) -> np.ndarray:
    """The fold of each text that has a model without it, else ``WHOLE``."""
    fold = pa.compute.fill_null(column, WHOLE).to_numpy(**({} if isinstance(column, pa.ChunkedArray) else {"zero_copy_only": False}))
    return np.where(np.isin(fold, list(models)), fold, WHOLE)


def _joined_perplexities(docs: DataFrame, shared: Sharded) -> DataFrame:
    """As ``perplexities``, by joins on n-grams.

    The documents are dealt into slices of some MiB. A slice asks once for each of its n-grams; the answers come from joins
    with the counts, and go back to their slice. So the rows that are shuffled are different n-grams of slices, not of documents.
    """
    rest = [c for c in docs.columns if c != "text"]
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    known = list(shared.symbols)

    def deal(batches):
        task, number, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                size = piece.column("text").nbytes
                if held and held + size > SLICE_BYTES:
                    number, held = number + 1, 0
                held += size
                name = pa.array([f"{task}-{number}"] * piece.num_rows)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in [*rest, "text"]), name], names=[*rest, "text", "_slice"])

    def ask(batches):
        # what the present slice has asked for, per model
        present, asked = None, {}
        for batch in batches:
            names = batch.column("_slice")
            for name in names.unique().to_pylist():
                if name != present:
                    present, asked = name, {}
                own = batch.filter(pa.compute.equal(names, name))
                fold = _folds(own.column("fold"), known) if "fold" in rest else np.full(own.num_rows, WHOLE)
                for k in {WHOLE, *fold.tolist()}:
                    some = own if k == WHOLE else own.filter(pa.array(fold == k))
                    grams = _grams(*_code_points(some.column("text").to_pylist()))
                    hashes, first = np.unique(_hashes(grams), return_index=True)
                    before = asked.get(k, np.zeros(0, np.uint64))
                    new = np.isin(hashes, before, assume_unique=True, invert=True)
                    asked[k] = np.concatenate([before, hashes[new]])
                    first = first[new]
                    columns = [pa.array([name] * len(first), pa.string()), pa.array(np.full(len(first), k, np.int32)), _binary(grams[first])]
                    yield pa.RecordBatch.from_arrays(columns, names=["_slice", "_model", "_gram"])

    dealt = kept(small_batches(docs).mapInArrow(deal, f"{plain}, text string, _slice string"), "dealt")
    wanted = kept(dealt.mapInArrow(ask, "_slice string, _model int, _gram binary"), "wanted")
    valued = wanted.select("_model", "_gram").distinct().withColumn("_factor", F.lit(1.0)).withColumn("_found", F.lit(None).cast("double"))
    for order in range(ORDER, 0, -1):
        suffix = F.substring(F.col("_gram"), CODE * (ORDER - order) + 1, CODE * order)
        p = shared.p.filter(F.col("order") == order).select(F.col("model").alias("_model"), F.col("gram").alias("_own"), "p")
        b = shared.backoff.filter(F.col("order") == order).select(
            F.col("model").alias("_model"), F.col("context").alias("_before"), "backoff"
        )
        valued = (
            valued.withColumn("_own", suffix)
            .withColumn("_before", _context(suffix, order))
            .join(p, ["_model", "_own"], "left")
            .join(b, ["_model", "_before"], "left")
            .select(
                "_model",
                "_gram",
                F.coalesce("_found", F.col("_factor") * F.col("p")).alias("_found"),
                (F.col("_factor") * F.coalesce("backoff", F.lit(1.0))).alias("_factor"),
            )
        )
    unseen = F.col("_factor") / _of_model(shared.symbols, "_model")
    valued = valued.select("_model", "_gram", F.log(F.coalesce("_found", unseen)).alias("_log"))
    answers = wanted.distinct().join(valued, ["_model", "_gram"])
    names = [*rest, "n_chars_scored", "perplexity", *(["unseen"] if "fold" in rest else [])]

    def score(texts: pa.Table, logs: pa.Table) -> pa.Table:
        points, sizes = _code_points(texts.column("text").to_pylist())
        own, which = np.unique(_hashes(_grams(points, sizes)), return_inverse=True)
        of_model, log = logs.column("_model").to_numpy(), logs.column("_log").to_numpy()
        hashes = _hashes(_symbols(logs.column("_gram"), ORDER))

        def values(k: int, of: np.ndarray) -> np.ndarray:
            """Logarithms of the n-grams ``of``, all of which model k was asked for."""
            there = np.flatnonzero(of_model == k)
            there = there[np.argsort(hashes[there])]
            return log[there][np.searchsorted(hashes[there], of)]

        found = [_means(values(WHOLE, own)[which], sizes, sizes > 0)]
        if "fold" in rest:
            fold = _folds(texts.column("fold"), known)
            of, unseen = np.repeat(fold, sizes), np.zeros(len(which))
            for k in np.setdiff1d(fold[sizes > 0], [WHOLE]):
                unseen[of == k] = values(k, own[which[of == k]])
            found.append(_means(unseen[of != WHOLE], sizes, fold != WHOLE))
        return pa.Table.from_arrays([*(texts.column(c) for c in rest), pa.array(sizes), *found], names=names)

    schema = f"{plain}, n_chars_scored long" + "".join(f", {c} double" for c in names[len(rest) + 1 :])
    return dealt.groupBy("_slice").cogroup(answers.groupBy("_slice")).applyInArrow(score, schema)


def perplexities(docs: DataFrame, shared) -> DataFrame:
    """Adds ``n_chars_scored`` and ``perplexity`` to rows that have ``text``, which is dropped.

    If there is a column ``fold``, also ``unseen``, the perplexity under the model without that fold; null without a fold or such a model.
    """
    if isinstance(shared, Sharded):
        return _joined_perplexities(docs, shared)
    rest = [c for c in docs.columns if c != "text"]
    names = [*rest, "n_chars_scored", "perplexity", *(["unseen"] if "fold" in rest else [])]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    schema += ", n_chars_scored long" + "".join(f", {c} double" for c in names[len(rest) + 1 :])

    def run(batches):
        models = _lookup(shared)
        for batch in batches:
            for piece in slices(batch, "text"):
                points, sizes = _code_points(piece.column("text").to_pylist())
                grams = _grams(points, sizes)
                _, first, which = np.unique(_hashes(grams), return_index=True, return_inverse=True)
                seen = grams[first]
                found = [_means(models[WHOLE].logs(seen)[which], sizes, sizes > 0)]
                if "fold" in rest:
                    fold = _folds(piece.column("fold"), models)
                    of, values = np.repeat(fold, sizes), np.zeros(len(which))
                    for k in np.setdiff1d(fold, [WHOLE]):
                        own = np.flatnonzero(of == k)
                        some, inverse = np.unique(which[own], return_inverse=True)
                        values[own] = models[k].logs(seen[some])[inverse]
                    there = fold != WHOLE
                    found.append(_means(values[of != WHOLE], sizes, there))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), pa.array(sizes), *found], names=names)

    return small_batches(docs).mapInArrow(run, schema)


def _gathered(frame: DataFrame, own_model: int, key: str, value: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Symbols and values of one model, order by order."""
    rows = frame.filter(F.col("model") == own_model).select("order", key, value).toArrow()
    tables = []
    for order in range(1, ORDER + 1):
        own = rows.filter(pa.compute.equal(rows.column("order"), order))
        tables.append((_symbols(own.column(key), order - (key == "context")), own.column(value).to_numpy().copy()))
    return tables


def train(trusted: DataFrame):
    """The models of the trusted texts, ready for ``perplexities``: that of all, and with a column ``fold`` those without each fold."""
    p, backoff, symbols = model(kept(gram_counts(trusted), "grams"))
    p, backoff = kept(p, "probabilities"), kept(backoff, "backoffs")
    if (p.count() + backoff.count()) * ROW_BYTES > common.BROADCAST_BYTES:
        return Sharded(p, backoff, symbols)
    models = {}
    for k, n in symbols.items():
        # within the bound of a broadcast, and of one model at a time what is gathered is held beside the arrays
        models[k] = (n, _gathered(p, k, "gram", "p"), _gathered(backoff, k, "context", "backoff"))
    pa.default_memory_pool().release_unused()
    return trusted.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, models))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: ``doc_id, lang, text_hash, n_chars_scored, perplexity, threshold, kept``.

    Trusted are all texts labelled ``quality = 1``. The threshold of a language is the accepted quantile of its trusted
    documents, each under a model without its fold (under the model of all if they are all in one fold), times the margin, higher for short texts; a language without trusted documents has that of all of them together. Without any
    trusted text the threshold is null and every text is kept. Null and empty texts have no perplexity and are not kept. A
    null language is a language of its own. Rows that repeat an id are each judged on their own text; labels that
    repeat an id count once, the best one. Other columns are ignored.
    """
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("_good")).distinct()
    good = broadcast_within(good, good.count(), 32)
    marked = docs.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).join(good, F.col("doc_id") == F.col("_good"), "left")
    fold = F.pmod(F.xxhash64("text"), F.lit(settings.folds)).cast("int")
    marked = marked.withColumn("fold", F.when(F.col("_good").isNotNull(), fold))
    shared = train(marked.filter("_good IS NOT NULL"))
    scored = kept(
        perplexities(
            marked.select(
                "doc_id", "lang", F.xxhash64("text").alias("text_hash"), F.col("_good").isNotNull().alias("trusted"), "fold", "text"
            ),
            shared,
        ),
        "perplexity",
    )
    if not isinstance(shared, Sharded):
        shared.destroy()  # every text has its perplexity; else the driver holds the models as long as it runs
    bins = (
        scored.filter("trusted AND perplexity IS NOT NULL")
        .groupBy("lang", F.ceil(F.log(F.coalesce("unseen", "perplexity")) * settings.bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_lang = _quantile(bins, settings, ["lang"])
    overall = _quantile(bins, settings, []).withColumnRenamed("threshold", "overall").select("overall")
    short = F.greatest(
        F.lit(0.0), 1 / F.sqrt(F.greatest(F.col("n_chars_scored"), F.lit(1))) - 1 / settings.settled**0.5
    )
    limited = (
        scored.join(F.broadcast(by_lang), scored["lang"].eqNullSafe(by_lang["lang"]), "left")
        .drop(by_lang["lang"])
        .join(F.broadcast(overall), F.lit(True), "left")
        .withColumn("threshold", F.coalesce("threshold", "overall") * F.exp(settings.scatter * short))
    )
    fits = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return limited.select(
        "doc_id", "lang", "text_hash", "n_chars_scored", "perplexity", "threshold", fits.alias("kept")
    )


def _quantile(bins: DataFrame, settings: Settings, by: list[str]) -> DataFrame:
    """Upper edge of the bin that holds the quantile; the bins of a language are bounded in number."""
    from pyspark.sql import Window

    per_bin = bins.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    ordered = Window.partitionBy(*by).orderBy("bin") if by else Window.partitionBy(F.lit(1)).orderBy("bin")
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    reached = per_bin.withColumn("upto", F.sum("n").over(ordered)).withColumn("all", F.sum("n").over(whole))
    return (
        reached.filter(F.col("upto") >= F.col("all") * settings.quantile)
        .groupBy(*by)
        .agg((F.exp(F.min("bin") / settings.bins) * settings.margin).alias("threshold"))
    )


def without_rejected(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents, with all their columns, whose perplexity is accepted."""
    rejected = kept(
        classify(docs, labels, settings).filter("NOT kept").select("doc_id", "text_hash").distinct(), "rejected"
    )
    rejected = broadcast_within(rejected, rejected.count(), 64)
    same = docs["doc_id"].eqNullSafe(rejected["doc_id"]) & (F.xxhash64(docs["text"]) == rejected["text_hash"])
    return docs.join(rejected, same, "left_anti")
