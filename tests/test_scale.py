"""Ranks, heavy joins, the interval index and pruned reads: results against brute force, and the shape of the work."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridvoice.functions import skew
from gridvoice.operators import correlation, enrich
from gridvoice.sources import readers, sinks


@pytest.fixture
def plain(spark):
    """Adaptive execution off, so that nothing is mended at run time; 16 partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


# ---- ranks -------------------------------------------------------------------------


def test_ranks_equal_an_ordered_list(plain):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = [
        (k, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, start, start + timedelta(seconds=rng.randrange(9))])) for k in range(600)
    ]
    df = plain.createDataFrame(rows, "id long, client long, at timestamp").repartition(7)
    got = {r["id"]: r["rang"] for r in enrich.with_sequence_number(df, "client", "at", "id", "rang").collect()}
    for client in (1, 2, 3, None):
        own = sorted((r for r in rows if r[1] == client), key=lambda r: (r[2] is not None, r[2] or start, r[0]))
        assert [got[r[0]] for r in own] == list(range(1, len(own) + 1))


def test_one_client_and_second_is_spread(plain):
    """Half of two million rows are of one client and second, a quarter of one client without a time."""
    id_ = F.col("id")
    df = plain.range(2_000_000, numPartitions=8).select(
        "id",
        F.when(id_ % 4 < 3, F.when(id_ % 4 == 2, 8).otherwise(7)).otherwise(id_ % 1000 + 10).alias("client"),
        F.when(id_ % 4 < 2, F.timestamp_seconds(F.lit(0))).when(id_ % 4 == 3, F.timestamp_seconds(id_)).alias("at"),
    )
    ranked = enrich.with_sequence_number(df, "client", "at", "id", "rang")
    seen = ranked.filter("client IN (7, 8)").groupBy("client").agg(
        F.count("*").alias("n"), F.min("rang").alias("low"), F.max("rang").alias("high"), F.count_distinct("rang").alias("k")
    )
    assert sorted(map(tuple, seen.collect())) == [(7, 1_000_000, 1, 1_000_000, 1_000_000), (8, 500_000, 1, 500_000, 500_000)]
    # by id, as the rows of one second are ordered
    assert ranked.filter((F.col("client") == 7) & (F.col("rang") != F.floor(F.col("id") / 4) * 2 + F.col("id") % 4 + 1)).count() == 0
    assert max(per_task(ranked)) < 3 * 2_000_000 / 16


# ---- heavy joins ---------------------------------------------------------------------


def test_heavy_join_equals_a_plain_one_and_is_spread(plain):
    id_ = F.col("id")
    key = F.when(id_ % 2 == 0, 5).when(id_ % 10 == 1, None).when(id_ % 10 == 3, -id_).otherwise(id_ % 5000)
    facts = plain.range(400_000, numPartitions=16).select("id", key.alias("k"), (id_ * 2).alias("v"))
    dim = plain.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w"))
    joined = skew.left_join_heavy(facts, dim, "k", limit=-1)
    plain_join = facts.join(dim, "k", "left").select("id", "k", "v", "w")

    def digest(df):
        return df.agg(F.count("*"), F.count("w"), F.sum(F.xxhash64("id", "k", "v", "w").cast("decimal(38,0)"))).first()

    assert joined.columns == ["id", "k", "v", "w"]
    assert digest(joined) == digest(plain_join) == digest(skew.left_join_heavy(facts, dim, "k"))
    assert max(per_task(joined)) <= 400_000 / 16
    shuffled = facts.join(dim.hint("merge"), "k", "left")
    assert max(per_task(shuffled)) >= 200_000


def test_sketch_finds_every_heavy_key(plain):
    rng = random.Random(5)
    keys = [1] * 500 + [2] * 60 + [rng.randrange(10, 10**6) for _ in range(5000)] + [None] * 3000
    df = plain.createDataFrame([(k,) for k in keys], "k long")
    found = skew.heavy_buckets(df, "k", 0.01, 800).collect()
    for heavy in (1, 2):
        where = df.filter(F.col("k") == heavy).select(*skew._sketch_buckets(F.col("k"), 800)).first()
        assert {(row, b) for row, b in enumerate(where)} <= {tuple(r) for r in found}
    assert len(found) <= skew.DEPTH / 0.01


# ---- intervals -------------------------------------------------------------------------


def test_intervals_tile_the_days(spark):
    rng = random.Random(6)
    spans = [(a := rng.randrange(-50, 20_000), a + rng.choice([-1, 0, 1, 2, 7, 30, 400, 5000])) for _ in range(300)]
    spans += [(0, 100_000), (-3, 70_000)]
    df = spark.createDataFrame(spans, "a int, b int").withColumn("k", F.explode(F.array(*[F.lit(k) for k in correlation.LEVELS])))
    nodes = df.withColumn("n", F.explode(correlation._nodes(F.col("a"), F.col("b"), F.col("k"))))
    found = {s: [] for s in spans}
    for r in nodes.collect():
        found[r["a"], r["b"]].append((r["k"], r["n"]))
    for (a, b), own in found.items():
        assert sorted(d for k, n in own for d in range(n * 2**k, (n + 1) * 2**k)) == list(range(a, b + 1))
        assert len(own) <= 6 * max(1, (b - a + 2).bit_length())


def zone_rows(rng, n, near):
    start = datetime(2010, 1, 1)
    place = lambda: round(rng.choice([rng.uniform(0, near), rng.randrange(0, 10) / 10]), 3)
    sites = [(k, place() if k % 17 else None, place(), start + timedelta(hours=rng.randrange(0, 16 * 365 * 24))) for k in range(n)]
    lives = []
    for k in range(n // 4):
        at = (start + timedelta(days=rng.randrange(0, 16 * 365))).date()
        end = rng.choice([None, at, at + timedelta(days=rng.randrange(0, 40)), at + timedelta(days=rng.randrange(0, 4000)), at - timedelta(days=1)])
        lives.append((k, place(), place() if k % 19 else None, at, end))
    return sites, lives


@pytest.mark.parametrize("hot, near", [(500, 3.0), (2, 3.0), (0, 0.15)])
def test_zones_equal_brute_force(spark, hot, near):
    sites, lives = zone_rows(random.Random(7), 400, near)
    complaints = spark.createDataFrame(sites, "id int, latitude double, longitude double, date_creation timestamp")
    incidents = spark.createDataFrame(lives, "id int, latitude double, longitude double, date_incident date, date_fin date")
    as_of = "2026-01-01 00:00:00"
    got = {r["id"]: r["est_lie_incident"] for r in correlation.in_incident_zone(complaints, incidents, as_of, hot=hot).collect()}
    last = datetime(2026, 1, 1)
    for k, lat, lon, at in sites:
        want = lat is not None and any(
            y is not None
            and x - 0.1 <= lat <= x + 0.1
            and y - 0.1 <= lon <= y + 0.1
            and datetime(a.year, a.month, a.day) <= at <= (datetime(b.year, b.month, b.day) if b else last)
            for _, x, y, a, b in lives
        )
        assert got[k] == want, (k, lat, lon, at)
    assert 20 < sum(got.values()) < 400


def test_rows_of_an_incident_do_not_grow_with_its_age(spark):
    old = [(0.05, 0.05, datetime(2014, 1, 1).date(), None), (0.05, 0.05, datetime(2023, 12, 1).date(), None)]
    df = spark.createDataFrame(old, "latitude double, longitude double, date_incident date, date_fin date")
    counts = {r["_start"].year: r["count"] for r in correlation.incident_nodes(df, "2024-01-01 00:00:00").groupBy("_start").count().collect()}
    assert counts[2014] <= 9 * 6 * 6 and counts[2014] < 4 * counts[2023]


def sides_sent_to_all(df, column):
    """Build sides with an exploded column that semi joins of the plan send to all tasks."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        children = [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName().startswith("BroadcastHashJoin") and ("LeftSemi" in node.simpleString(50) or "LeftAnti" in node.simpleString(50)):
            found += [text for text in [children[1].treeString()] if "explode" in text and f"{column}#" in text]
        todo += children
    return found


@pytest.mark.parametrize("n, hot, column, sent", [(4000, 100_000, "_node", False), (40, 100_000, "_node", True), (4000, 20, "_px", False)])
def test_exploded_nodes_of_many_incidents_are_not_broadcast(spark, n, hot, column, sent):
    lives = spark.range(n).select(
        (F.col("id") % 100 / 10).alias("latitude"),
        (F.col("id") % 77 / 10).alias("longitude"),
        F.date_add(F.lit("2014-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("date_incident"),
        F.lit(None).cast("date").alias("date_fin"),
    )
    complaints = spark.range(100).select(
        "id",
        (F.col("id") / 10).alias("latitude"),
        (F.col("id") % 77 / 10).alias("longitude"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2015-06-01 00:00:00")) + F.col("id") * 15_000).alias("date_creation"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = correlation.in_incident_zone(complaints, lives, "2024-01-01 00:00:00", hot=hot)
        assert bool(sides_sent_to_all(got, column)) is sent
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ten_year_old_incidents_in_one_cell(spark):
    """Twenty thousand open incidents and as many complaints share a cell or its neighbours."""
    old = spark.range(20_000).select(
        (F.lit(0.05) + F.rand(1) * 0.04).alias("latitude"),
        (F.lit(0.05) + F.rand(2) * 0.04).alias("longitude"),
        F.date_add(F.lit("2014-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("date_incident"),
        F.lit(None).cast("date").alias("date_fin"),
    )
    complaints = spark.range(20_000).select(
        "id",
        (F.rand(3) * 0.2).alias("latitude"),
        (F.rand(4) * 0.2).alias("longitude"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2014-06-01 00:00:00")) + F.col("id") * 15_000).alias("date_creation"),
    )
    got = correlation.in_incident_zone(complaints, old, "2024-01-01 00:00:00")
    alive = F.col("date_creation") <= F.lit("2024-01-01 00:00:00").cast("timestamp")
    near = alive & F.col("latitude").between(0.0, 0.14) & F.col("longitude").between(0.0, 0.14)
    assert got.filter(near & ~F.col("est_lie_incident")).count() == 0
    assert got.filter(~alive & F.col("est_lie_incident")).count() == 0


# ---- pruned reads ---------------------------------------------------------------------------


def test_only_selected_folders_are_read(spark, tmp_path):
    path, other = str(tmp_path / "facts"), str(tmp_path / "years")
    rows = spark.range(3000).select("id", (F.col("id") % 12 + 2000).cast("int").alias("annee"))
    sinks.write_parquet(rows, path, ["annee"])
    years = spark.range(12).select((F.col("id") + 2000).cast("int").alias("annee"), (F.col("id") % 4).alias("quart"))
    sinks.write_parquet(years, other)
    found = readers.read_selected(spark, path, spark.read.parquet(other).filter("quart = 1"), ["annee"])
    assert sorted({r["annee"] for r in found.collect()}) == [2001, 2005, 2009]
    assert "dynamicpruning" in found._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = readers.read_selected(spark, path, spark.read.parquet(other).filter("quart = 1"), ["annee"])
        assert again.count() == 750
        frame = again.groupBy().count()
        frame.collect()
        leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(k) for k in range(leaves.size()) if "facts" in leaves.apply(k).toString()]
        assert [s.metrics().apply("numPartitions").value() for s in scans] == [3]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
