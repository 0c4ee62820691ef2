"""Eigenpairs and whitened vectors against dense linear algebra on the driver."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridvoice.llm import jacobi_davidson, queries, whitening

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("spread", ["even", "falling", "equal", "low rank"])
def test_solver_against_dense(spread):
    rng = np.random.default_rng(3)
    dim = 90
    sizes = {
        "even": np.linspace(2, 1, dim),
        "falling": 0.8 ** np.arange(dim),
        "equal": np.repeat([5.0, 3.0, 1.0], 30),
        "low rank": np.r_[np.arange(12, 0, -1.0), np.zeros(dim - 12)],
    }[spread]
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    matrix = turn * sizes @ turn.T
    calls = []

    def product(u):
        calls.append(u.shape[1])
        return matrix @ u

    values, vectors = jacobi_davidson.largest(product, dim, 32)
    assert np.abs(values - sizes[:32]).max() < 1e-13 * sizes[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-13 * sizes[0]
    assert np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12
    assert max(calls) <= 2 * jacobi_davidson.Settings().block  # never the whole matrix in one product
    assert len(calls) > 5


def test_products_with_noise_still_converge():
    rng = np.random.default_rng(4)
    data = rng.standard_normal((500, 80))
    matrix = data.T @ data / 500
    values, _ = jacobi_davidson.largest(lambda u: (matrix @ u) * (1 + 1e-13 * rng.standard_normal((80, 1))), 80, 20)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:20]).max() < 1e-10


def test_minres_solves():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    right = rng.standard_normal((30, 3))
    right[:, 1] = 0
    found = jacobi_davidson.minres(lambda x: a @ x, right, 200, 1e-12)
    assert np.abs(a @ found - right).max() < 1e-8


def expected(vectors):
    """Everything the contract asks for, from a dense covariance and whole numbers."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    return x, n, [int(((n * r - sums).astype(object) ** 2).sum()) for r in x], e, centred @ u / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(v)


def compare(rows, ids, vectors):
    _, n, deviations, values, white, shares = expected(vectors)
    size = min(32, white.shape[1])
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(found) == len(ids) * size
    for k in range(size):
        column = np.array([found[i, k + 1]["whitened"] for i in ids])
        sign = np.sign(column @ white[:, k])
        assert np.abs(column - sign * white[:, k]).max() < 1e-7
    for i, deviation in zip(ids, deviations):
        r = found[i, 1]
        assert r["n"] == n and r["deviation"] == deviation
        assert abs(r["explained"] / shares[0] - 1) < 1e-9 and r["identity_error"] < 1e-9


def test_query_on_the_table(few):
    table = pq.read_table(f"{SMALL}/embeddings.parquet")
    rows = queries.QUERIES["op12_whitening"](few, SMALL).collect()
    compare(rows, table["vec_id"].to_pylist(), table["embedding"].to_pylist())


def test_odd_rows_are_dropped(few):
    rng = np.random.default_rng(6)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, [])]
    odd += [(105, [1.0, 2.0]), (106, [1.0, 2.0, 3.0, 4.0])]
    docs = few.createDataFrame(good + odd, "vec_id long, embedding array<double>")
    docs = docs.withColumns({c: F.lit(1) for c in ("x", "finite", "n", "component", "block")})
    compare(whitening.whiten(docs).collect(), [i for i, _ in good], [v for _, v in good])


def test_repeated_rows_and_null_ids(few):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 5.0]), (2, [3.0, 3.0])]
    got = whitening.whiten(few.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted([r["vec_id"] for r in got], key=str) == [1, 1, 1, 1, 2, 2, None, None]
    assert {r["n"] for r in got} == {4} and got[0]["identity_error"] < 1e-10


def test_no_variance_gives_no_rows(few):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(few.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(few.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(few.createDataFrame([(1, None)], schema)).collect() == []
    line = few.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)], schema)
    assert [r["component"] for r in whitening.whiten(line).collect()] == [1] * 5


def test_huge_entries(few):
    rows = [(i, [1e300 * (-1) ** i, float(i % 3)]) for i in range(6)]
    got = whitening.whiten(few.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {2**63 - 1} and got[0]["identity_error"] < 1e-4
