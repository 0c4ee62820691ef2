"""Resharding by minimum-cost flow.

1. Documents of an old shard fall into blocks, by power of two of their size and a hash. The sizes of the blocks, a number fixed
   by parameters, go to the driver.
2. A minimum-cost flow from old shard sizes to new capacities says how many bytes go from where to where; a byte
   that stays costs nothing.
3. The blocks of an old shard whose sum is nearest to what the flow leaves there stay; the others are given to its arcs, large
   ones first, so that small ones even out the rest. Bytes moved are charged where shards are evened out.
4. Only shards that lose or gain a block are rewritten. A row's block follows from the row itself, so whole rows go to
   their shards without a join on ids.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridvoice.llm.common import kept

#: Bytes that a document takes besides its text.
OVERHEAD = 16
#: Documents of one block that are numbered by one task.
RUN = 512


@dataclass(frozen=True)
class Settings:
    """Old shards, new shards, blocks per old shard and size class."""

    old_shards: int = 32
    shards: int = 40
    blocks: int = 32


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Bytes from each old to each new shard: all supply at least cost, within the demands.

    Successive shortest paths with potentials; costs are not negative and the demands suffice.
    """
    if sum(supply) > sum(demand):
        raise ValueError("the new shards cannot hold everything")
    n, m = len(supply), len(demand)
    left, room = list(supply), list(demand)
    flow = [[0] * m for _ in range(n)]
    potential = [0] * (n + m)
    while any(left):
        # distances from all old shards that still have bytes, along arcs with a reduced cost
        distance: list[float] = [0 if k < n and left[k] else float("inf") for k in range(n + m)]
        came: list[int | None] = [None] * (n + m)
        queue = [(0, k) for k in range(n) if left[k]]
        done = [False] * (n + m)
        while queue:
            d, u = heapq.heappop(queue)
            if done[u]:
                continue
            done[u] = True
            arcs = (
                ((n + j, cost[u][j]) for j in range(m))
                if u < n
                else ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
            )
            for v, price in arcs:
                new = d + price + potential[u] - potential[v]
                if new < distance[v]:
                    distance[v], came[v] = new, u
                    heapq.heappush(queue, (new, v))
        ends = [j for j in range(m) if room[j] and distance[n + j] < float("inf")]
        end = min(ends, key=lambda j: (distance[n + j] + potential[n + j], j))
        furthest = distance[n + end]
        for k in range(n + m):
            potential[k] += min(distance[k], furthest)
        path, at = [], n + end
        while came[at] is not None:
            path.append((came[at], at))
            at = came[at]
        amount = min([left[at], room[end]] + [flow[v][u - n] for u, v in path if u >= n])
        for u, v in path:
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[at] -= amount
        room[end] -= amount
    return flow


def transfers(
    blocks: list[tuple[int, int, int, int]], settings: Settings, cost: list[list[int]] | None = None
) -> dict[tuple[int, int, int], int]:
    """New shard of each block ``(old shard, size class, number, bytes)``; loads come out nearly equal."""
    n, m = settings.old_shards, settings.shards
    supply = [0] * n
    for old, _, _, size in blocks:
        supply[old] += size
    total = sum(supply)
    demand = [total // m + (j < total % m) for j in range(m)]
    if cost is None:
        cost = [[int(i != j) for j in range(m)] for i in range(n)]
    wanted = min_cost_flow(supply, demand, cost)
    load, chosen = [0] * m, {}
    ordered = sorted(blocks, key=lambda b: (-b[3], b))
    for old in range(min(n, m)):
        own = [b for b in ordered if b[0] == old]
        for position in _nearest_sum([b[3] for b in own], wanted[old][old]):
            chosen[own[position][:3]] = old
            load[old] += own[position][3]
        wanted[old][old] = -total  # nothing more stays
    for old, kind, number, size in ordered:
        if (old, kind, number) in chosen:
            continue
        # what the flow still sends there; once that is used up, the emptiest of its targets
        to = max(range(m), key=lambda j: (wanted[old][j], demand[j] - load[j], -j))
        wanted[old][to] -= size
        load[to] += size
        chosen[old, kind, number] = to
    _even_out(blocks, chosen, load)
    return chosen


def _nearest_sum(sizes: list[int], goal: int, steps: int = 1 << 16) -> list[int]:
    """Positions of the sizes whose sum is nearest to the goal, to about a part in ``steps``.

    Sums are bits of a number; that of the first k sizes is kept for each k, to read the choice backwards.
    """
    if sum(sizes) <= goal:
        return list(range(len(sizes)))
    unit = max(1, goal // steps)
    units = [(size + unit // 2) // unit for size in sizes]
    aim = goal // unit
    within = (1 << (2 * aim + 1)) - 1  # zero is never further than twice the goal
    reached = [1]
    for size in units:
        reached.append((reached[-1] | reached[-1] << size if size <= 2 * aim else reached[-1]) & within)
    below = (reached[-1] & ((1 << (aim + 1)) - 1)).bit_length() - 1
    above = reached[-1] >> aim
    above = aim + (above & -above).bit_length() - 1 if above else 2 * aim + 1
    left, positions = below if aim - below <= above - aim else above, []
    for position in reversed(range(len(units))):
        if not reached[position] >> left & 1:
            positions.append(position)
            left -= units[position]
    return positions


def least_moved(blocks: list[tuple[int, int, int, int]], settings: Settings) -> int:
    """Bytes that any layout with equal loads has to move: what the old shards hold above an equal share."""
    supply = [0] * max(settings.old_shards, settings.shards)
    for old, _, _, size in blocks:
        supply[old] += size
    total, m = sum(supply), settings.shards
    share = [total // m + (j < total % m) if j < m else 0 for j in range(len(supply))]
    return sum(max(0, have - may) for have, may in zip(supply, share))


def _even_out(blocks, chosen: dict, load: list[int], steps: int = 20_000) -> None:
    """Move a block, or swap two, from a full to the emptiest shard as long as that brings them together.

    A change that takes blocks away from their old shard is charged their bytes, so blocks that move anyway go first.
    It ends when all are within a two-thousandth of their mean, or nothing helps.
    """
    held: dict[int, list[tuple[int, tuple[int, int, int]]]] = {j: [] for j in range(len(load))}
    for old, kind, number, size in blocks:
        held[chosen[old, kind, number]].append((size, (old, kind, number)))
    close = max(1, sum(load) // len(load) // 2000)
    for _ in range(steps):
        order = sorted(held, key=lambda j: (load[j], j))
        empty = order[0]
        for full in reversed(order[1:]):
            gap = load[full] - load[empty]
            if gap <= close:
                return
            change = _best_change(_priced(held[full], full, empty), _priced(held[empty], empty, full), gap)
            if change is None:
                continue
            out, back = change
            moving = [(full, empty, held[full].pop(out))]
            if back is not None:
                moving.append((empty, full, held[empty].pop(back)))
            for source, target, (size, key) in moving:
                held[target].append((size, key))
                load[source] -= size
                load[target] += size
                chosen[key] = target
            break
        else:
            return


def _priced(held: list[tuple[int, tuple[int, int, int]]], at: int, to: int) -> np.ndarray:
    """Size of each block of a shard, and the bytes moved more (or less) if it goes from there to another one."""
    return np.array([(size, size * ((old == at) - (old == to))) for size, (old, _, _) in held], np.int64).reshape(-1, 2).T


def _best_change(full: np.ndarray, empty: np.ndarray, gap: int) -> tuple[int, int | None] | None:
    """Positions of the block to move, and of one to take back, if any.

    What goes over lies nearest to half the gap, with the bytes that are moved more added to the distance.
    """
    # taking nothing back is the first column
    size = full[0][:, None] - np.concatenate([[0], empty[0]])[None, :]
    price = full[1][:, None] + np.concatenate([[0], empty[1]])[None, :]
    useful = (size > 0) & (size < gap)
    if not useful.any():
        return None
    loss = np.abs(2 * size - gap) + 2 * price
    best = int(np.where(useful, loss, np.iinfo(np.int64).max).argmin())
    out, back = divmod(best, size.shape[1])
    return out, back - 1 if back else None


#: What a row's place follows from, null-safe.
KEYS = ["old_shard", "kind", "block"]


def _blocked(doc_id: Column, text: Column, old_shard: Column, settings: Settings) -> dict[str, Column]:
    """Size, checksum and block of a row."""
    text = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    return {
        "size": size,
        "text_crc32": F.crc32(text),
        "old_shard": old_shard.cast("int"),
        "kind": F.floor(F.log2(size) + 1e-9).cast("int"),
        "block": F.pmod(F.xxhash64(doc_id, F.crc32(text)), F.lit(settings.blocks)).cast("int"),
    }


def _with_blocks(docs: DataFrame, old_shard: Column, settings: Settings) -> DataFrame:
    found = _blocked(F.col("doc_id"), F.col("text"), old_shard, settings)
    return docs.select("doc_id", *[c.alias(name) for name, c in found.items()])


def _plan(rows: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """``(old_shard, kind, block, shard)``, one row per block, and the most rows of a block."""
    sums = rows.groupBy(*KEYS).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    chosen = transfers([(r["old_shard"], r["kind"], r["block"], r["bytes"]) for r in sums], settings)
    plan = rows.sparkSession.createDataFrame(
        [(*k, shard) for k, shard in chosen.items()], "old_shard int, kind int, block int, shard int"
    )
    return plan, max((r["n"] for r in sums), default=0)


def by_source(settings: Settings) -> Column:
    """Old shard of a document: a hash of its source. A null source counts as an empty one."""
    source = F.coalesce(F.col("source").cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(source), F.lit(settings.old_shards))


def layout(docs: DataFrame, old_shard: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, old_shard, shard, slot``; the shards' sizes are nearly equal.

    Null and empty texts have the size of the overhead. Every row has a place, also rows that repeat an id or have a null one. Slots
    of a shard count from 0 without gaps. An empty table gives an empty table.
    """
    rows = kept(_with_blocks(docs, by_source(settings) if old_shard is None else old_shard, settings), "sizes")
    plan, most = _plan(rows, settings)
    return _slots(rows.join(F.broadcast(plan), KEYS), most)


def _slots(placed: DataFrame, most: int) -> DataFrame:
    """The layout of rows with their blocks and shards; ``most`` rows are in the fullest block."""
    runs = max(1, -(-most // RUN))
    split = placed.withColumn("run", F.pmod(F.xxhash64("text_crc32", "doc_id", F.lit(7)), F.lit(runs)).cast("int"))
    counted = split.groupBy(*KEYS, "run", "shard").agg(F.count(F.lit(1)).alias("n"))
    shard = Window.partitionBy("shard").orderBy(*KEYS, "run")
    before = counted.select(*KEYS, "run", "shard", (F.sum("n").over(shard) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy(*KEYS, "run", "shard").orderBy("doc_id", "text_crc32")) - 1
    return (
        split.withColumn("within", within)
        .join(before, [*KEYS, "run", "shard"])
        .select(
            "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("before") + F.col("within")).alias("slot")
        )
    )


def reshard(docs: DataFrame, new_path: str, old_shard: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """Write the shards that lose or gain a block to ``new_path/new_shard=k``, whole rows, and return the layout as it is
    then stored.

    Rows of written shards are read back from there: sizes, checksums and old shards are those of the stored rows. Shards
    without a change are not written. Rows are treated as by ``layout``; rows with a null id and rows that
    repeat an id are written as often as they are there. Columns may have any name but ``new_shard``.
    """
    spark = docs.sparkSession
    old_shard = by_source(settings) if old_shard is None else old_shard
    rows = kept(_with_blocks(docs, old_shard, settings), "sizes")
    plan, most = _plan(rows, settings)
    moved = plan.filter("old_shard <> shard")
    affected = moved.select("shard").unionByName(moved.select(F.col("old_shard").alias("shard"))).distinct()
    affected = sorted(r[0] for r in affected.collect())  # at most one row per shard
    found = _blocked(F.col("doc_id"), F.col("text"), old_shard, settings)
    at = F.struct(*[found[k].alias(k) for k in KEYS])
    to = plan.select(F.struct(*KEYS).alias("_at"), F.col("shard").alias("new_shard"))
    going = docs.withColumn("_at", at).join(F.broadcast(to), "_at").drop("_at").filter(F.col("new_shard").isin(affected))
    _write(going, "new_shard", new_path)
    stored = spark.read.schema(going.schema).parquet(new_path)
    written = _blocked(F.col("doc_id"), F.col("text"), old_shard, settings)
    again = stored.select("doc_id", *[c.alias(name) for name, c in written.items()], F.col("new_shard").alias("shard"))
    stayed = rows.join(F.broadcast(plan), KEYS).filter(~F.col("shard").isin(affected))
    return _slots(kept(again.unionByName(stayed), "stored"), most)


def _write(rows: DataFrame, shard: str, path: str) -> None:
    """One folder per shard; a large shard is several files."""
    rows.hint("rebalance", F.col(shard)).write.mode("overwrite").partitionBy(shard).parquet(path)


def rewrite_affected(docs: DataFrame, places: DataFrame, old_path: str, new_path: str) -> DataFrame:
    """Write the shards that lose or gain rows to ``new_path/shard=k``; ``(shard, path)`` says where each shard is now.

    ``docs`` has the column ``old_shard`` and lies under ``old_path/shard=k``; ``places(doc_id, old_shard, shard)`` is the new
    layout. Places with ``size`` and ``text_crc32``, as ``layout`` gives them, tell rows that repeat an id apart. Every row, also
    one with a null id, is written once; a row without a place or with several is an error. Shards without a change are not
    read or written again.
    """
    spark = docs.sparkSession
    keys = [c for c in ("doc_id", "old_shard", "size", "text_crc32") if c in places.columns]
    moved = places.filter("old_shard <> shard")
    affected = moved.select("shard").unionByName(moved.select(F.col("old_shard").alias("shard"))).distinct()
    affected = sorted(r[0] for r in affected.collect())  # at most one row per shard
    # equal rows share one block, so their place is one
    of = F.struct(*keys)
    unique = kept(places.groupBy(of.alias("_of")).agg(F.min("shard").alias("shard"), F.max("shard").alias("_most")), "places")
    if unique.filter("shard <> _most").limit(1).count():
        raise ValueError("rows of one id have several places; they need size and text_crc32")
    found = {"doc_id": F.col("doc_id")} | _blocked(F.col("doc_id"), F.col("text"), F.col("old_shard"), Settings())
    own = F.struct(*[found[k].alias(k) for k in keys])
    # only shards that are rewritten are read; a row of another one stays where it is
    reading = docs.filter(F.col("old_shard").isin(affected)).withColumn("_of", own)
    going = reading.join(unique.drop("_most"), "_of", "left").drop("_of", "old_shard")
    placed = F.when(F.col("shard").isNull(), F.raise_error(F.lit("a row has no place")).cast("int")).otherwise(F.col("shard"))
    _write(going.withColumn("shard", placed), "shard", new_path)
    all_shards = sorted(r[0] for r in places.select("shard").distinct().collect())
    return spark.createDataFrame(
        [(s, f"{new_path if s in affected else old_path}/shard={s}") for s in all_shards], "shard int, path string"
    )
