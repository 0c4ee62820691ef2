"""Links, counts and components against all pairs."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridvoice.llm import multi_index as M
from gridvoice.llm import queries

SMALL = "/root/testdata/sf0.01"


def brute(rows, least=0.98):
    """Plain comparison of all rows: (vec_id, n_links, component_id, kept) in the order of the rows."""

    def usable(label, v):
        return label is not None and bool(v) and all(e is not None and np.isfinite(e) for e in v) and any(v)

    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i, (_, x, label) in enumerate(rows):
        for j in range(i):
            _, y, other = rows[j]
            if usable(label, x) and usable(other, y) and label == other and len(x) == len(y):
                a, b = (np.array(v, np.float64) / np.abs(v).max() for v in (x, y))
                linked[i, j] = linked[j, i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least
    out = []
    for i, (own, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(linked[todo.pop()]).tolist()) - seen
            seen |= new
            todo += new
        least_id = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((own, int(linked[i].sum()), least_id, least_id is None or least_id == own))
    return out


def compare(spark, rows, settings=M.Settings()):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.withColumns({c: F.lit("x") for c in ("node", "cell", "h1", "usable", "copies", "vector", "kept")})
    got = sorted(map(tuple, M.near_duplicates(frame, settings).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def clusters(seed, dim=10, labels=3, n=260):
    """Chains and bunches of near copies at, above and below the similarity."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = rng.standard_normal(dim)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            near = centre + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.1, 0.2]) * np.linalg.norm(centre) / dim**0.5
            rows.append((len(rows) * 3 % 997, (near * rng.choice([1, 3])).tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("codes, block", [(2, 4096), (8, 7), (16, 30)])
def test_all_links_are_found(few, codes, block):
    compare(few, clusters(codes), M.Settings(codes=codes, block=block))


def test_odd_rows(few):
    same = [1.0, 2.0, 3.0]
    rows = [(9, same, 1), (4, same, 1), (4, same, 1), (4, [-1.0, 0.0, 0.5], 1), (7, [2.0, 4.0, 6.0], 1), (1, same, 2), (2, same, None)]
    rows += [(20, None, 1), (21, [], 1), (22, [0.0, 0.0, -0.0], 1), (23, [1.0, None, 3.0], 1), (24, [1.0, float("nan"), 3.0], 1)]
    rows += [(25, [float("inf"), 0.0, 0.0], 1), (None, [1.0, 2.0, 3.1], 1), (None, [5.0, 0.0, -5.0], 1), (30, [1.0, 2.0], 1)]
    rows += [(31, [1.0, 2.0, 0.0], 1), (32, [1e200, 2e200, 3e200], 1), (33, [0.0, 1.0, 0.0], 3), (34, [-0.0, 1.0, 0.0], 3)]
    rows += [(40, [2.0], 5), (41, [3.0], 5), (42, [-3.0], 5)]
    compare(few, rows)


def test_no_usable_rows(few):
    schema = "vec_id long, embedding array<double>, label int"
    assert M.near_duplicates(few.createDataFrame([], schema)).collect() == []
    assert [tuple(r) for r in M.near_duplicates(few.createDataFrame([(3, None, 1)], schema)).collect()] == [(3, 0, 3, True)]


def test_most_rows_are_one_vector(few):
    rng = np.random.default_rng(8)
    hot = rng.standard_normal(6).tolist()
    rows = [(i, hot if i % 3 else rng.standard_normal(6).tolist(), 1) for i in range(400)]
    compare(few, rows, M.Settings(block=16))


def test_bounds_hold():
    rng = np.random.default_rng(9)
    x = M.units(rng.standard_normal((400, 12)).tolist(), 12)
    near = M.units((x + rng.standard_normal(x.shape) * 0.04).tolist(), 12)
    grid = M.Grid(M.codebook(x[:, :6], 16, 8, 1), M.codebook(x[:, 6:], 16, 8, 2))
    cells, _ = grid.look(near)
    own, who, where = grid.visits(x, 0.04 + M.SLACK)
    visited = set(zip(who.tolist(), where.tolist()))
    linked = (x * near).sum(axis=1) >= 0.98
    assert linked.sum() > 100
    assert all((i, int(cells[i])) in visited for i in np.flatnonzero(linked))
    assert len(visited) < 0.7 * len(x) * grid.cells


def test_lower_target_visits_less_and_still_finds_most():
    rng = np.random.default_rng(10)
    x = M.units(rng.standard_normal((1500, 32)).tolist(), 32)
    grid = M.Grid(M.codebook(x[:, :16], 32, 8, 1), M.codebook(x[:, 16:], 32, 8, 2))
    lower = M.radius_for(M.Settings(target_recall=0.95), grid, x)
    assert lower < 0.5 * M.radius_for(M.Settings(), grid, x)
    near = M.units((x + rng.standard_normal(x.shape) * 0.03).tolist(), 32)
    cells, _ = grid.look(near)
    _, who, where = grid.visits(x, lower)
    visited = set(zip(who.tolist(), where.tolist()))
    assert np.mean([(i, int(cells[i])) in visited for i in range(len(x))]) > 0.9


def test_forest_joins_what_is_linked():
    rng = np.random.default_rng(11)
    for _ in range(60):
        n, more = rng.integers(1, 20), rng.integers(0, 20)
        linked = rng.random((n, n + more)) < rng.choice([0.02, 0.1])
        linked[:, :n] |= linked[:, :n].T
        np.fill_diagonal(linked, False)
        size = n + more

        def groups(pairs):
            label = list(range(size))
            for _ in range(size):
                for a, b in pairs:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        edges = M.forest(linked)
        assert len(edges) < size
        assert groups(edges) == groups(list(zip(*np.nonzero(linked))))


def test_query_equals_its_sql(few):
    got = {r["vec_id"]: r["n_links"] for r in queries.QUERIES["op13_embedding_duplicates"](few, SMALL).collect()}
    view = f"SELECT * FROM '{SMALL}/embeddings.parquet'"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS {view}")
    want = {r[0]: r[1] for r in con.execute(f"SELECT vec_id, n_links FROM ({queries.SQL['op13_embedding_duplicates']})").fetchall()}
    assert got == want
