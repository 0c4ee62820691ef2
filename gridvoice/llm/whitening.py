"""Whitened embeddings: projections on the unit eigenvectors of the covariance, each scaled to variance 1.

The eigenvectors come from Jacobi-Davidson (``jacobi_davidson``). It never sees the covariance: each product of it with a few
vectors is one Spark job over the centred rows, of which every partition returns one sum of the size of the vectors. These sums
are added by Spark, so the driver holds vectors of the dimension and no rows.

Entries are put on a grid of whole numbers, so sums and deviations are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.llm import jacobi_davidson
from gridvoice.llm.common import kept, small_batches

MOST = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    """Components, grid steps per unit and offset of the grid, and the share of the variance below which a component is rounding only.

    Grid values beyond ``limit`` are set to it, so that sums stay exact.
    """

    components: int = 32
    steps: int = 64
    offset: int = 1_000_000
    least_share: float = 1e-12
    limit: int = 2**51
    solver: jacobi_davidson.Settings = jacobi_davidson.Settings()


@dataclass(frozen=True)
class Fit:
    """Rows, exact sums per dimension, values and vectors of the components, their share of the variance, and the error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def on_grid(vectors: DataFrame, settings: Settings, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, x)``: vectors without null or non-finite entries, on the grid of whole numbers."""
    c = F.col(vec_col).cast("array<double>")
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    top, base = F.lit(float(settings.limit)), F.lit(settings.offset).cast("long")
    x = F.transform(c, lambda e: F.floor(F.greatest(F.least(e * settings.steps, top), -top)) + base)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), finite.alias("finite"))
    return rows.filter("finite AND size(x) > 0").select("vec_id", "x")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""

    def run(batches):
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                part = _matrix(batch).sum(axis=0).astype(object)
                total = part if total is None else total + part
        if n:
            numbers = [n, *total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(numbers) - 1), pa.int32()), pa.array([str(v) for v in numbers])], names=["place", "total"]
            )

    parts = small_batches(rows.select("x")).mapInArrow(run, "place int, total string")
    found = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    by_place = {r["place"]: int(r["total"]) for r in found}
    return by_place.pop(-1, 0), [by_place[k] for k in sorted(by_place)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact; as Python integers where 64 bits may not hold them."""
    middle = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    away = x - middle
    if int(np.abs(away).max(initial=0)) * n > 2**62:
        return away.astype(object) * n - rest.astype(object)
    return away * np.int64(n) - rest


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(np.float64)


def _added(blocks: DataFrame, partial, size: int) -> np.ndarray:
    """The sum over all blocks of ``partial(block)``, an array of ``size`` numbers; one row per number reaches the driver."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for block in batch.column("block"):
                total += partial(np.frombuffer(block.as_buffer(), np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["slot", "value"])

    added = blocks.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[added.column("slot").to_numpy()] = added.column("value").to_numpy()
    return out


def _blocks(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Centred rows as doubles, one binary value for each batch of them."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_centred(_matrix(batch), n, sums).tobytes()], pa.binary())], names=["block"]
                )

    return kept(small_batches(rows.select("x")).mapInArrow(run, "block binary"), "centred")


def fit(rows: DataFrame, settings: Settings = Settings()) -> Fit:
    """Components of ``rows(vec_id, x)``, all of one dimension."""
    n, sums = _sums(rows)
    dim = len(sums)
    nothing = Fit(n, sums, np.empty(0), np.empty((dim, 0)), np.empty(0), 0.0)
    if not n:
        return nothing
    blocks = _blocks(rows, n, sums)
    trace = float(_added(blocks, lambda block: np.array([block @ block]), 1)[0]) / n
    if not trace > 0:
        return nothing

    def product(u):
        width = u.shape[1]

        def partial(block):
            d = block.reshape(-1, dim)
            return (d.T @ (d @ u)).ravel()

        return _added(blocks, partial, dim * width).reshape(dim, width) / n

    values, vectors = jacobi_davidson.largest(product, dim, settings.components, settings.solver)
    real = values > settings.least_share * trace
    values, vectors = values[real], vectors[:, real]
    size = len(values)
    scaled = vectors / np.sqrt(values)
    means = _added(blocks, lambda block: (block.reshape(-1, dim) @ scaled).sum(axis=0), size) / n

    def covariance(block):
        w = block.reshape(-1, dim) @ scaled - means
        return (w.T @ w).ravel()

    error = np.abs(_added(blocks, covariance, size * size).reshape(size, size) / n - np.eye(size)).max()
    return Fit(n, sums, values, vectors, values / trace, float(error))


def whiten(
    vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped. Vectors of another length than the most
    frequent one (of equally frequent ones the longest) are dropped as well. Components are numbered by falling variance; those whose variance is
    rounding only, as in a table of one row or of equal rows, are left out, so such a table gives no rows. Of components with
    equal variance any orthonormal set is as good. Repeated rows and ids count as often as they stand there; null ids are kept. Very
    large entries are cut to the grid's limit, and deviations beyond 64 bits are the largest long. Other columns are
    ignored. An empty table gives an empty table.
    """
    rows = kept(on_grid(vectors, settings, id_col, vec_col), "grid")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    if lengths:
        rows = rows.filter(F.size("x") == lengths[0]["length"])
    found = fit(rows, settings)
    n, sums, size = found.n, found.sums, len(found.values)
    scaled = found.vectors / np.sqrt(found.values)
    explained, error = found.explained, found.identity_error

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not size:
                continue
            away = _deviations(_matrix(batch), n, sums)
            whole = (away.astype(object) ** 2).sum(axis=1) if away.dtype == object else None
            if whole is None:
                rough = (away.astype(np.float64) ** 2).sum(axis=1)
                if rough.max() > 2**62:
                    whole = (away.astype(object) ** 2).sum(axis=1)
            deviation = (away**2).sum(axis=1) if whole is None else np.array([min(v, MOST) for v in whole], np.int64)
            white = (away / n).astype(np.float64) @ scaled
            many = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(many), size))),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * size, n, np.int64)),
                    pa.array(np.repeat(deviation, size)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, many)),
                    pa.array(np.full(many * size, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return small_batches(rows).mapInArrow(run, schema)
