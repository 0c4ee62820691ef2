"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.llm.common import kept

#: Upper limit that no real graph reaches: the number of rounds grows with the logarithm of a path's length.
ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    links = _both_ways(edges)
    least = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        links.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; every edge points to the smaller end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    The rounds end when the edges are stars, that is when two rounds give the same edges.
    Each round is written to the shared folder. Self links and repeated links are allowed;
    links with a null end are ignored; without links the result is empty.
    """
    current = kept(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = None
    for _ in range(ROUNDS):
        found = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if not found[0]:
            break
        # every node has one edge and no target has an edge of its own: these are stars
        if found[0] == found[2] and tuple(found) == mark:
            break
        mark = tuple(found)
        current = kept(_small_star(_large_star(current)), "stars")
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
