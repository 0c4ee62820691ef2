"""Near duplicates among embeddings by an inverted multi-index.

1. Rows of equal label and vector are one class; one row per class goes on.
2. Unit vectors are cut into halves, and each half has its own codebook, fitted on a sample. The pairs of codes are the cells of a grid
   that all classes are put into.
3. From each class the cells are visited in the order of their distance: per half the codes are sorted by the least distance at
   which a vector of that code can lie, and the two sorted lists are walked together. The walk ends at the radius of the
   similarity, which no linked vector can lie beyond: recall is 1. A lower target recall ends it earlier.
4. Members of a cell are compared with each other and with its visitors, in blocks, in double precision. A pair of cells is
   visited from one side only.
5. Blocks return the number of links of each class and a spanning forest of the links, not the links. Components come from large-star
   and small-star steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.llm.common import broadcast_within, kept, small_batches
from gridvoice.llm.components import components


@dataclass(frozen=True)
class Settings:
    """Least cosine, target recall, codes per half (None: from the number of rows), rows the codebooks are fitted on (about),
    rounds of that fit, rows per block, seed."""

    cosine: float = 0.98
    target_recall: float = 1.0
    codes: int | None = None
    sample: int = 16_384
    rounds: int = 10
    block: int = 4096
    seed: int = 5


#: Rounding of distances: cells this much beyond the radius are visited as well.
SLACK = 1e-9


def codes_for(rows: int) -> int:
    """Codes per half for the largest label: more rows, finer cells, so that cells keep some dozens of rows."""
    return int(min(1024, max(4, 2 ** round(np.log2(max(rows, 1) ** 0.5 / 8)))))


def units(vectors: list, dim: int) -> np.ndarray:
    """Unit vectors, filled up with zeros to one dimension."""
    out = np.zeros((len(vectors), dim))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1), 0)


def codebook(x: np.ndarray, codes: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of a k-means fit; equal centres count once."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.choice(len(distinct), min(codes, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = squared(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        count = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return np.unique(centres, axis=0)


class Grid:
    """Two codebooks and the least squared distance from a vector to any vector of a code."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = (first, second)
        self.apart = [np.sqrt(squared(b, b)) for b in self.books]
        for gaps in self.apart:
            np.fill_diagonal(gaps, np.inf)
            gaps[gaps == 0] = np.inf

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        cut = self.books[0].shape[1]
        return [x[:, :cut], x[:, cut:]]

    def look(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The cell of each vector, and per half the least squared distance to the vectors of each code.

        A vector of code i is nearer to i than to the own code, so it lies beyond the plane half-way between the two.
        """
        own, least = [], []
        for part, book, gaps in zip(self.halves(x), self.books, self.apart):
            d = squared(part, book)
            nearest = d.argmin(axis=1)
            beyond = (d - d.min(axis=1, keepdims=True)) / (2 * gaps[nearest])
            own.append(nearest)
            least.append(beyond**2)
        return own[0] * len(self.books[1]) + own[1], least

    def visits(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cells, and the other cells within the squared radius: which vector visits which cell.

        Both lists are sorted; step k takes the k-th nearest code of the first half and as much of the second list as still fits, for all
        vectors at once, until no vector has a code left.
        """
        cells, (first, second) = self.look(x)
        order1, order2 = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
        first, second = np.take_along_axis(first, order1, 1), np.take_along_axis(second, order2, 1)
        who, where = [], []
        for k in range(first.shape[1]):
            row, at = np.nonzero(second <= radius - first[:, k : k + 1])
            if not len(row):
                break
            who.append(row)
            where.append(order1[row, k] * len(self.books[1]) + order2[row, at])
        if not who:
            return cells, np.empty(0, np.int64), np.empty(0, np.int64)
        return cells, np.concatenate(who), np.concatenate(where)


def radius_for(settings: Settings, grid: Grid, sample: np.ndarray) -> float:
    """Squared distance at which the walk ends.

    At a target recall of 1 it is that of two unit vectors exactly at the similarity. Below it, it is the quantile of the bounds of neighbours made
    exactly at the similarity, in random directions, from the sample.
    """
    exact = 2 - 2 * settings.cosine + SLACK
    if settings.target_recall >= 1:
        return exact
    rng = np.random.default_rng(settings.seed)
    away = rng.standard_normal(sample.shape)
    away -= (away * sample).sum(axis=1, keepdims=True) * sample
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    near = settings.cosine * sample + np.sqrt(1 - settings.cosine**2) * away
    cells, _ = grid.look(near)
    _, (first, second) = grid.look(sample)
    width, at = len(grid.books[1]), np.arange(len(sample))
    needed = first[at, cells // width] + second[at, cells % width]
    return min(exact, float(np.quantile(needed, settings.target_recall)) + SLACK)


def fit(classes: DataFrame, settings: Settings, dim: int) -> tuple[Grid, np.ndarray]:
    """Codebooks from about ``settings.sample`` classes, chosen by a hash of the vector."""
    n = classes.count()
    share = min(1.0, settings.sample / n)
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    chosen = F.pmod(F.xxhash64("vector", F.lit(settings.seed)), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = classes.filter(F.lit(share == 1.0) | chosen).select("vector").toArrow().column("vector").to_pylist()
    sample = units(rows or [classes.select("vector").first()[0]], dim)
    codes, cut = settings.codes or codes_for(largest), (dim + 1) // 2
    parts = [codebook(x, codes, settings.rounds, settings.seed + k) for k, x in enumerate((sample[:, :cut], sample[:, cut:]))]
    return Grid(*parts), sample


def _placed(classes: DataFrame, grid: Grid, radius: float, dim: int, with_vectors: bool) -> DataFrame:
    """``(label, cell, member, node[, copies, unit])``: each class in its cell, and as a visitor of later cells within the radius."""
    fields = "label string, cell long, member boolean, node long"

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = units(batch.column("vector").to_pylist(), dim)
            cells, who, where = grid.visits(x, radius)
            onward = where > cells[who]  # the other side visits this one
            who, where = who[onward], where[onward]
            rows = pa.array(np.concatenate([np.arange(len(x)), who]))
            member = np.zeros(len(rows), bool)
            member[: len(x)] = True
            columns = [
                batch.column("label").take(rows),
                pa.array(np.concatenate([cells, where]).astype(np.int64)),
                pa.array(member),
                batch.column("node").take(rows),
            ]
            names = ["label", "cell", "member", "node"]
            if with_vectors:
                columns += [batch.column("copies").take(rows), pa.array([v.tobytes() for v in x], pa.binary()).take(rows)]
                names += ["copies", "unit"]
            out = pa.RecordBatch.from_arrays(columns, names=names)
            for at in range(0, out.num_rows, 4096):
                yield out.slice(at, 4096)

    alike = F.concat_ws(" ", F.size("vector"), F.col("label").cast("string"))  # vectors of one label and length are compared
    given = classes.select(alike.alias("label"), "node", "copies", "vector")
    return small_batches(given).mapInArrow(run, fields + ", copies long, unit binary" * with_vectors)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what ``linked`` joins: a star for each component.

    Rows are the first columns too. Each row and column is looked at once.
    """
    rows, columns = linked.shape
    free = linked.any(axis=1)
    new_column = np.ones(columns, bool)
    out = []
    for seed in range(rows):
        if not free[seed]:
            continue
        free[seed], new_column[seed] = False, False
        front = np.array([seed])
        while len(front):
            reached = np.flatnonzero(linked[front].any(axis=0) & new_column)
            new_column[reached] = False
            out += [(seed, int(c)) for c in reached]
            inside = reached[reached < rows]
            outside = reached[reached >= rows]
            free[inside] = False
            front = inside
            if len(outside):
                more = np.flatnonzero(linked[:, outside].any(axis=1) & free)
                new = more[new_column[more]]
                out += [(seed, int(c)) for c in new]
                new_column[new] = False
                free[more] = False
                front = np.concatenate([inside, more])
    return out


def _compared(placed: DataFrame, sizes: DataFrame, settings: Settings) -> DataFrame:
    """``(a, b, links)``: for b null the number of rows a links to in a block, otherwise a link of the spanning forest.

    Members and visitors of a cell are cut into blocks by a hash of their node. Group (i, k) compares the members of block i with each other
    (k = i), with the members of block k (k > i) and with the visitors of block k.
    """
    each = settings.block
    rows = placed.join(sizes, ["label", "cell"])
    rows = rows.withColumn("blocks", F.when(F.col("member"), F.col("member_blocks")).otherwise(F.col("visitor_blocks")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    block, wide = F.col("block"), F.greatest("member_blocks", "visitor_blocks")
    left = F.filter(
        F.transform(F.sequence(F.lit(0), wide - 1), lambda k: F.struct(block.alias("i"), k.alias("k"), F.lit(True).alias("left"))),
        lambda s: (s["k"] >= block) | (s["k"] < F.col("visitor_blocks")),
    )

    def right(upto):
        places = F.when(upto > 0, F.sequence(F.lit(0), upto - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("i"), block.alias("k"), F.lit(False).alias("left")))

    places = F.when(F.col("member"), F.concat(left, right(block))).otherwise(right(F.col("member_blocks")))
    groups = rows.withColumn("place", F.explode(places)).select(
        "label", "cell", "place.i", "place.k", "place.left", "member", "node", "copies", "unit"
    )

    def compare(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy()
        order = np.argsort(~left, kind="stable")
        nodes, copies = (table.column(c).to_numpy()[order] for c in ("node", "copies"))
        member, n = table.column("member").to_numpy()[order], int(left.sum())
        x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(nodes), -1)[order]
        same = table.column("i")[0].as_py() == table.column("k")[0].as_py()
        linked = np.zeros((n, len(nodes)), bool)
        for at in range(0, n, 512):
            linked[at : at + 512] = x[at : min(at + 512, n)] @ x.T >= settings.cosine
        if same:
            np.fill_diagonal(linked, False)
        else:
            linked[:, :n] = False
        own, other = linked.any(axis=1), linked.any(axis=0)
        counts = np.zeros(len(nodes), np.int64)
        for at in range(0, n, 512):
            counts[at : min(at + 512, n)] += (linked[at : at + 512].astype(np.float64) @ copies).astype(np.int64)
            counts[n:] += (copies[at : min(at + 512, n)] @ linked[at : at + 512, n:].astype(np.float64)).astype(np.int64)
        assert member[:n].all()
        edges = forest(linked) if own.any() else []
        other[:n] |= own
        some = np.flatnonzero(other)
        a = np.concatenate([nodes[some], nodes[[e[0] for e in edges]]]) if edges else nodes[some]
        b = [None] * len(some) + [int(nodes[e[1]]) for e in edges]
        links = np.concatenate([counts[some], np.zeros(len(edges), np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return groups.groupBy("label", "cell", "i", "k").applyInArrow(compare, "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal label and length whose cosine, in double precision, is ``settings.cosine`` or more are linked. ``n_links`` counts the
    other rows a row is linked to; the component is the smallest id reachable; a row is kept if it has that id.

    Null labels, null, empty and zero vectors, and vectors with null or non-finite entries are linked with nothing and are kept. Rows that
    repeat an id are vectors of their own; equal rows are linked with each other. A row with a null id takes part in links; its component is the
    smallest id reachable, or null if there is none, and then it is kept. Other columns are ignored. An empty table gives an empty table.
    """
    c = F.transform(F.col(vec_col).cast("array<double>"), lambda e: e + F.lit(0.0))  # no negative zeros
    usable = F.col(label_col).isNotNull() & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = F.coalesce(usable & F.exists(c, lambda e: e != 0), F.lit(False))
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), c.alias("vector"), usable.alias("usable"))
    given = given.withColumn("vector", F.when(F.col("usable"), F.col("vector")))

    def marks(df):
        label = F.col("label").cast("string")
        return df.withColumns({"h1": F.xxhash64("vector", label), "h2": F.xxhash64(F.lit(1), label, "vector")})

    classes = marks(
        given.filter("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("head"), F.count(F.lit(1)).alias("copies"))
    )
    # numbered once: the table is written with its numbers
    classes = kept(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    everything = marks(given).select("vec_id", "h1", "h2", "usable")
    dim = classes.agg(F.max(F.size("vector"))).first()[0]
    if dim is None:
        return everything.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    grid, sample = fit(classes, settings, dim)
    radius = radius_for(settings, grid, sample)

    count = F.count(F.when(F.col("member"), 1)), F.count(F.when(~F.col("member"), 1))
    sizes = _placed(classes, grid, radius, dim, with_vectors=False).groupBy("label", "cell").agg(
        *(F.ceil(n / settings.block).cast("int").alias(name) for n, name in zip(count, ("member_blocks", "visitor_blocks")))
    )
    sizes = kept(sizes.filter("member_blocks > 0"), "cells")  # nothing to visit elsewhere
    sizes = broadcast_within(sizes, sizes.count(), 64)
    found = kept(_compared(_placed(classes, grid, radius, dim, with_vectors=True), sizes, settings), "links")

    links = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    labels = components(found.filter("b IS NOT NULL").select("a", "b"))
    heads = classes.select("node", "head", "copies", "h1", "h2")
    labels = kept(labels.join(heads.select("node", "head"), "node"), "labels")
    least = kept(labels.groupBy("component").agg(F.min("head").alias("component_id")), "least")
    labels = labels.join(broadcast_within(least, least.count(), 32), "component").select("node", "component_id")
    summary = kept(
        heads.join(links, "node", "left")
        .join(labels, "node", "left")
        .select(
            "h1",
            "h2",
            "copies",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "head").alias("component_id"),
        ),
        "summary",
    )

    # a class of more than a thousandth of the rows is sent to all tasks, there are fewer than a thousand of them
    heavy = F.lit(everything.count() / 1000) < F.col("copies")
    told = ["h1", "h2", "n_links", "component_id"]
    many = F.broadcast(summary.filter(heavy).select(*told, F.lit(True).alias("many")))
    rows = everything.filter("usable").join(many, ["h1", "h2"], "left")
    rare = rows.filter("many IS NULL").select("vec_id", "h1", "h2").join(summary.filter(~heavy).select(*told), ["h1", "h2"])
    columns = ["vec_id", "n_links", "component_id"]
    alone = everything.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = rows.filter("many").select(columns).unionByName(rare.select(columns)).unionByName(alone)
    return result.withColumn("kept", F.col("component_id").isNull() | F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
