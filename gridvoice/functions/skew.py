"""Building blocks that stay balanced when one key holds a large share of all rows.

A window function sends a whole key group to one task. The helpers here first
reduce with map-side partial aggregation and then join the small result back;
the join keeps the wide side splittable by adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridvoice.sources.scratch import materialise

# Catalyst estimates compressed file bytes; in memory a table is several times larger.
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of a plan (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimated size is under ``limit``.

    Beyond the limit the frame is returned untouched, so the join falls back to a
    shuffled one that adaptive execution may still split or convert.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


#: Rows of a side of a join that may be sent to all tasks, some tens of bytes each.
SMALL_ROWS = 100_000


def broadcast_if_few(df: DataFrame, rows: int, limit: int = SMALL_ROWS) -> DataFrame:
    """Side of a join with a counted number of rows: hinted to be broadcast up to ``limit`` rows, shuffled and sorted beyond it.

    Catalyst takes exploded rows for as small as the rows they were made of, and compressed files for as small as on disk. So it
    would build tables of any size on the driver; the count decides instead.
    """
    return F.broadcast(df) if rows <= limit else df.hint("merge")


def attach_group_stats(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Add per-group aggregates to every row (nulls in a key form a group)."""
    names = {k: f"_k_{k}" for k in keys}
    stats = df.groupBy(*[F.col(k).alias(names[k]) for k in keys]).agg(*[c.alias(n) for n, c in aggs.items()])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])
    return df.join(stats, on, "inner").drop(*names.values())


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    ``min(struct)`` merges copies before the shuffle, so a key with a huge number
    of copies costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    bin_width: float,
) -> DataFrame:
    """Exact interpolated percentiles per key, without one task holding a group.

    Rows are counted per bin; the running count tells which bins hold the wanted
    ranks; only distinct values of those few bins are then ordered. The number of
    bins depends on the range of the value, not on the number of rows.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"), F.floor(F.col(value) / bin_width).alias("_bin")
    )
    bins = rows.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    ordered = W.partitionBy(*keys).orderBy("_bin")
    bins = bins.select(
        *keys,
        "_bin",
        "_n",
        (F.sum("_n").over(ordered) - F.col("_n")).alias("_before"),
        F.sum("_n").over(W.partitionBy(*keys)).alias("_total"),
    )
    ranks = []
    for i, p in enumerate(probs.values()):
        position = (F.col("_total") - 1) * F.lit(float(p))
        for side, rank in enumerate((F.floor(position), F.ceil(position))):
            ranks.append(
                F.struct(
                    F.lit(2 * i + side).alias("slot"),
                    rank.alias("rank"),
                    (position - F.floor(position)).alias("frac"),
                )
            )
    wanted = (
        bins.select(*keys, "_bin", "_n", "_before", F.explode(F.array(*ranks)).alias("_r"))
        .filter((F.col("_r.rank") >= F.col("_before")) & (F.col("_r.rank") < F.col("_before") + F.col("_n")))
        .select(*keys, "_bin", "_before", F.col("_r.slot").alias("_slot"), F.col("_r.rank").alias("_rank"), F.col("_r.frac").alias("_frac"))
    )
    in_bin = (
        rows.join(wanted.select(*keys, "_bin").distinct(), [*keys, "_bin"], "left_semi")
        .groupBy(*keys, "_bin", "_v")
        .agg(F.count(F.lit(1)).alias("_m"))
    )
    by_value = W.partitionBy(*keys, "_bin").orderBy("_v")
    in_bin = in_bin.withColumn("_upto", F.sum("_m").over(by_value))
    hit = wanted.join(in_bin, [*keys, "_bin"]).filter(
        (F.col("_rank") - F.col("_before") >= F.col("_upto") - F.col("_m"))
        & (F.col("_rank") - F.col("_before") < F.col("_upto"))
    )
    outputs = []
    for i, name in enumerate(probs):
        low = F.max(F.when(F.col("_slot") == 2 * i, F.col("_v")))
        high = F.max(F.when(F.col("_slot") == 2 * i + 1, F.col("_v")))
        frac = F.max(F.when(F.col("_slot") == 2 * i, F.col("_frac")))
        outputs.append((low + (high - low) * frac).alias(name))
    return hit.groupBy(*keys).agg(*outputs)


#: Rows of a count-min sketch; a key's estimate is too high by more than ``e / width`` of the rows with a chance of e ** -DEPTH.
DEPTH = 4


def _sketch_buckets(key: Column, width: int) -> list[Column]:
    """The bucket of a key in each row of a count-min sketch."""
    return [F.pmod(F.xxhash64(F.lit(row), key), F.lit(width)).cast("int") for row in range(DEPTH)]


def heavy_buckets(df: DataFrame, key: str, share: float, width: int) -> DataFrame:
    """Buckets ``(_row, _bucket)`` of a count-min sketch of the key that hold at least ``share`` of the rows with a key.

    The sketch is an ordinary aggregation into ``DEPTH * width`` numbers, whatever the number of keys.
    """
    filled = df.filter(F.col(key).isNotNull()).select(F.posexplode(F.array(*_sketch_buckets(F.col(key), width))).alias("_row", "_bucket"))
    counts = filled.groupBy("_row", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(W.partitionBy("_row"))
    return counts.withColumn("_total", total).filter(F.col("_n") >= share * F.col("_total")).select("_row", "_bucket")


def left_join_heavy(
    df: DataFrame, dim: DataFrame, key: str, share: float = 0.001, width: int | None = None, limit: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame:
    """Left join in which no key brings a large part of ``df`` into one task, whatever adaptive execution does.

    A dimension of an estimated size up to ``limit`` is broadcast. Otherwise a count-min sketch of ``df`` names the dimension rows that may belong to heavy keys, at least ``share`` of the rows. There are
    few of them, and they are broadcast, if their size allows; the rows they match stay where they are. The other rows are shuffled,
    and none of their keys is heavy. A key that is taken for heavy by mistake changes nothing in the result. ``dim`` is unique on the key.
    """
    if estimated_bytes(dim) <= limit:
        columns = [c for c in dim.columns if c != key]
        return df.join(F.broadcast(dim), key, "left").select(*df.columns, *columns)
    width = width or int(8 / share)
    heavy = materialise(heavy_buckets(df, key, share, width), "heavy")
    marked = dim
    for row, bucket in enumerate(_sketch_buckets(F.col(key), width)):
        of_row = heavy.filter(F.col("_row") == row).select(F.col("_bucket").alias("_b"))
        marked = marked.withColumn("_b", bucket).join(F.broadcast(of_row), "_b", "left_semi").drop("_b")
    few = materialise(marked, "heavy_rows")
    columns = [c for c in dim.columns if c != key]
    split = df.join(broadcast_if_small(few.withColumn("_heavy", F.lit(True))), key, "left")
    rest = split.filter(F.col("_heavy").isNull())
    named = rest.filter(F.col(key).isNotNull()).select(*df.columns).join(dim, key, "left").select(*df.columns, *columns)
    nameless = rest.filter(F.col(key).isNull()).select(*df.columns, *columns)
    return split.filter("_heavy").select(*df.columns, *columns).unionByName(named).unionByName(nameless)


#: Sides of the cells that are compared, from coarse to fine, as powers of two of the finest one.
_STEPS = (14, 12, 10, 9, 8, 6, 4, 2, 0)
#: Step of a key whose places all see the same points.
_WHOLE = 99
#: Degrees by which rounding may move a place out of its cell.
_SLACK = 1e-9


def nearest_point(
    sites: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    point_id: str,
    cell: float = 0.25,
    unit: float = 1.0,
    crowded: int = 500,
    busy: int = 4_000_000,
) -> DataFrame:
    """Nearest point of the same key for each distinct (key, latitude, longitude) site.

    Sites are compared with lists of points. A key with at most ``crowded`` points has one list, all of them. Otherwise both sides are
    put on a grid, and occupied cells are compared from coarse to fine (sides of ``cell`` times 64 down to ``cell`` / 256): a
    cell of sites keeps the cells of points that can hold the nearest one of any site in it, and is cut only while those hold more
    than ``crowded`` points, or more than ``busy`` pairs with its sites. Of their points only those enter the list that can
    be nearest. So no more than that is compared for a list, and what is written follows the number of sites, points and occupied
    cells: compared pairs are aggregated where they arise. Both inputs are evaluated once and written to the
    shared folder. The distance is in degrees times ``unit``; ties in that unit go to the smallest ``point_id``.
    """
    keys = list(keys)
    side = cell / 2**8
    sites, points = [
        materialise(
            df.withColumns({"_fx": F.floor(F.col("latitude") / side), "_fy": F.floor(F.col("longitude") / side)}), name
        )
        for df, name in ((sites, "sites"), (points.withColumnRenamed(point_id, "_id"), "points"))
    ]
    points = points.withColumnsRenamed({"latitude": "_plat", "longitude": "_plon"})
    number = F.count(F.lit(1))
    numbers = sites.groupBy(*keys).agg(number.alias("_ns")).join(points.groupBy(*keys).agg(number.alias("_np")), keys)
    numbers = materialise(numbers, "numbers")
    large = (F.col("_np") > crowded) | (F.col("_ns") * F.col("_np") > busy)
    found = numbers.agg(number.alias("keys"), F.count_if(large).alias("large")).first()

    tile, nothing = [*keys, "_step", "_sx", "_sy"], F.lit(0).cast("long")
    whole = numbers.filter(~large).select(*keys)
    steps = whole.withColumn("_steps", F.array(F.lit(_WHOLE)))
    lists = points.join(broadcast_if_few(whole, found["keys"] - found["large"]), keys, "left_semi")
    lists = lists.select(*keys, F.lit(_WHOLE).alias("_step"), nothing.alias("_sx"), nothing.alias("_sy"), "_plat", "_plon", "_id")
    if found["large"]:
        many = broadcast_if_few(numbers.filter(large).select(*keys), found["large"])
        cells, reached = _lists(sites.join(many, keys, "left_semi"), points.join(many, keys, "left_semi"), keys, side, crowded, busy)
        used = cells.groupBy(*keys).agg(F.collect_set("_step").alias("_steps"))
        steps = materialise(steps.unionByName(used), "steps")
        lists = lists.unionByName(reached)
    lists = lists.hint("merge")

    asked = sites.join(broadcast_if_few(steps, found["keys"]), keys).withColumn("_step", F.explode("_steps"))

    def at(c: str) -> Column:
        return F.when(F.col("_step") == _WHOLE, nothing).otherwise(F.call_function("shiftright", F.col(c), F.col("_step")))

    asked = asked.select(*keys, "_step", at("_fx").alias("_sx"), at("_fy").alias("_sy"), "latitude", "longitude")
    dlat, dlon = F.col("latitude") - F.col("_plat"), F.col("longitude") - F.col("_plon")
    distance = F.sqrt(dlat * dlat + dlon * dlon) * unit
    # Two passes over fixed-width values (hash aggregation, nothing sorted): the smallest distance of each site, then the smallest
    # id at that distance. Both groupings keep the key of the join, so the pairs stay in their tasks.
    site = [*tile, "latitude", "longitude"]
    best = asked.join(lists, tile).groupBy(*site).agg(F.min(distance).alias("distance"))
    at_best = best.join(lists, tile).filter(distance == F.col("distance"))
    picked = at_best.groupBy(*site, "distance").agg(F.min("_id").alias(point_id))
    return picked.select(*keys, "latitude", "longitude", "distance", point_id)


def _lists(
    sites: DataFrame, points: DataFrame, keys: list[str], side: float, crowded: int, busy: int
) -> tuple[DataFrame, DataFrame]:
    """Cells of sites and the points that can be nearest to a site in them, both with (keys, ``_step``, ``_sx``, ``_sy``).

    A cell of points can hold the nearest one only if its closest corner is no farther than the farthest corner of the best cell.
    """
    at_site, at_point = [*keys, "_sx", "_sy"], [*keys, "_px", "_py"]

    def on_step(df: DataFrame, prefix: str, step: int) -> DataFrame:
        return df.withColumns({f"{prefix}x": F.shiftright("_fx", step), f"{prefix}y": F.shiftright("_fy", step)})

    def counted(df: DataFrame, prefix: str, step: int, above: int | None) -> DataFrame:
        """Rows per cell of a step, with the cell of the step above that holds it."""
        parent = [] if above is None else [f"_{prefix}x", f"_{prefix}y"]
        df = on_step(df, f"_c{prefix}", step)
        df = df if above is None else on_step(df, f"_{prefix}", above)
        return df.groupBy(*keys, *parent, f"_c{prefix}x", f"_c{prefix}y").agg(F.count(F.lit(1)).alias(f"_n{prefix}")).hint("merge")

    cells, reached, undone = [], [], None
    for above, step in zip((None, *_STEPS), _STEPS):
        own, theirs = counted(sites, "s", step, above), counted(points, "p", step, above)
        pairs = own.join(theirs, keys) if undone is None else undone.join(own, at_site).join(theirs, at_point)
        pairs = pairs.select(*keys, *[F.col(f"_c{c}").alias(f"_{c}") for c in ("sx", "sy", "px", "py")], "_ns", "_np")
        dx, dy = F.abs(F.col("_sx") - F.col("_px")), F.abs(F.col("_sy") - F.col("_py"))
        near_x, near_y = F.greatest(dx - 1, F.lit(0)), F.greatest(dy - 1, F.lit(0))
        lower, upper = near_x * near_x + near_y * near_y, (dx + 1) * (dx + 1) + (dy + 1) * (dy + 1)
        best = pairs.groupBy(*at_site).agg(F.min(upper).alias("_best"))
        kept = materialise(pairs.join(best.hint("merge"), at_site).filter(lower <= F.col("_best")).drop("_best"), "cells")
        full = (F.sum("_np") > crowded) | (F.sum("_np") * F.max("_ns") > busy)
        full = full & F.lit(step != _STEPS[-1])  # the finest cells are compared as they are
        state = materialise(kept.groupBy(*at_site).agg(full.alias("_full")), "state")
        count = state.agg(F.count_if("_full").alias("full"), F.count_if(~F.col("_full")).alias("done")).first()
        kept = kept.select(*at_site, "_px", "_py")
        if count["done"]:
            done = kept.join(state.filter(~F.col("_full")).select(*at_site).hint("merge"), at_site)
            cells.append(done.select(*keys, F.lit(step).alias("_step")))
            near = _within_reach(done, on_step(points, "_p", step), at_site, at_point, side * 2**step)
            reached.append(near.select(*keys, F.lit(step).alias("_step"), "_sx", "_sy", "_plat", "_plon", "_id"))
        if not count["full"]:
            break
        undone = kept.join(state.filter("_full").select(*at_site).hint("merge"), at_site)
    return reduce(DataFrame.unionByName, cells), reduce(DataFrame.unionByName, reached)


def _within_reach(pairs: DataFrame, points: DataFrame, at_site: list[str], at_point: list[str], width: float) -> DataFrame:
    """Points of the paired cells that come as near to the cell of sites as the farthest site in it may be from the best point."""
    points = points.select(*at_point, "_plat", "_plon", "_id").hint("merge")

    def span(p: str, c: str) -> tuple[Column, Column]:
        """Least and greatest distance of a point to a cell along one axis."""
        below, beyond = F.col(c) * width - F.col(p), F.col(p) - (F.col(c) + 1) * width
        return F.greatest(below, beyond, F.lit(0.0)), F.greatest(-below, -beyond)

    (near_x, far_x), (near_y, far_y) = span("_plat", "_sx"), span("_plon", "_sy")
    nearest, farthest = F.sqrt(near_x * near_x + near_y * near_y), F.sqrt(far_x * far_x + far_y * far_y)
    # the pairs learn the reach first: points beyond it are not shuffled to the lists
    reach = pairs.join(points, at_point).groupBy(*at_site).agg(F.min(farthest).alias("_reach"))
    return pairs.join(reach.hint("merge"), at_site).join(points, at_point).filter(nearest <= F.col("_reach") + _SLACK)
