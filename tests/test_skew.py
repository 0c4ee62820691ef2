"""Skew-safe building blocks against brute force on small random data with hot keys."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from gridvoice.functions import skew
from gridvoice.operators import anomaly, cleaning, correlation, enrich


def hot_rows(n, seed, keys=6):
    rnd = random.Random(seed)
    # a third of all rows on one key
    return [(0 if rnd.random() < 0.34 else rnd.randrange(keys), rnd) for _ in range(n)], rnd


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles(spark, seed):
    rows, rnd = hot_rows(300 + seed, seed)
    data = [(k, round(rnd.gauss(50, 40), 1)) for k, _ in rows] + [(9, 3.0), (9, None)]
    df = spark.createDataFrame(data, "k int, v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.k: r for r in skew.exact_quantiles(df, ["k"], "v", probs, 7.5).collect()}
    for key in {k for k, _ in data}:
        values = sorted(v for k, v in data if k == key and v is not None)
        for name, p in probs.items():
            at = (len(values) - 1) * p
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert got[key][name] == pytest.approx(low + (high - low) * (at - math.floor(at)))


@pytest.mark.parametrize("cell", [0.5, 0.25, 3.0])
@pytest.mark.parametrize("crowded", [250_000, 3, 0])
def test_nearest_point(spark, cell, crowded):
    rnd = random.Random(7)
    sites = {(rnd.choice("AB"), round(rnd.uniform(-5, 5), 2), round(rnd.uniform(-5, 5), 2)) for _ in range(120)}
    points = {}
    for i in range(60):
        place = (rnd.choice("AB"), round(rnd.uniform(-5, 5), 1), round(rnd.uniform(3, 5), 1))
        points.setdefault(place, i)
    s = spark.createDataFrame(list(sites), "z string, latitude double, longitude double")
    p = spark.createDataFrame([(*k, i) for k, i in points.items()], "z string, latitude double, longitude double, id int")
    got = {(r.z, r.latitude, r.longitude): (r.distance, r.id) for r in skew.nearest_point(s, p, ["z"], "id", cell, crowded=crowded).collect()}
    for z, lat, lon in sites:
        best = min((math.sqrt((lat - a) ** 2 + (lon - b) ** 2), i) for (q, a, b), i in points.items() if q == z)
        assert got[(z, lat, lon)][1] == best[1]
        assert got[(z, lat, lon)][0] == pytest.approx(best[0])


def test_nearest_point_in_one_crowded_cell(spark):
    rnd = random.Random(1)
    s = spark.range(40_000).select(F.lit("A").alias("z"), (F.rand(1) * 0.25).alias("latitude"), (F.rand(2) * 0.25).alias("longitude"))
    places = [(rnd.random() * 0.25, rnd.random() * 0.25, i) for i in range(8_000)]
    p = spark.createDataFrame([("A", *x) for x in places], "z string, latitude double, longitude double, id int")
    began = time.perf_counter()
    got = skew.nearest_point(s, p, ["z"], "id").collect()
    assert time.perf_counter() - began < 90
    assert len(got) == 40_000
    for r in rnd.sample(got, 40):
        assert r.distance == pytest.approx(min(math.hypot(r.latitude - a, r.longitude - b) for a, b, _ in places))


@pytest.fixture
def written(monkeypatch):
    """Plans and numbers of rows of the intermediate tables that the search writes."""
    tables, keep = [], skew.materialise

    def noted(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        kept = keep(df, name)
        tables.append((name, plan, kept.count()))
        return kept

    monkeypatch.setattr(skew, "materialise", noted)
    return tables


@pytest.mark.parametrize("limits", [{}, {"crowded": 30}, {"busy": 2_000}])
def test_nearest_point_among_many_occupied_cells(spark, written, limits):
    """Sites and points in some thousand cells of one key, and points that are far from all sites: no table holds all pairs of cells."""
    rnd = random.Random(3)
    sites = list({(0, round(rnd.uniform(-8, 8), 2), round(rnd.uniform(-8, 8), 2)) for _ in range(1200)})
    sites += [(1, round(rnd.uniform(0, 1), 2), round(rnd.uniform(0, 1), 3)) for _ in range(60)]
    points = {(rnd.uniform(-8, 8), rnd.uniform(-8, 8)) for _ in range(900)}
    points = [(0, *p, i) for i, p in enumerate(sorted(points))]
    points += [(1, 30 + rnd.random() / 50, 30 + rnd.random() / 50, i) for i in range(100)] + [(2, 0.0, 0.0, 7)]
    s = spark.createDataFrame(sorted(set(sites)), "z int, latitude double, longitude double")
    p = spark.createDataFrame(points, "z int, latitude double, longitude double, id int")
    got = {(r.z, r.latitude, r.longitude): (r.distance, r.id) for r in skew.nearest_point(s, p, ["z"], "id", **limits).collect()}
    assert len(got) == len(set(sites))
    for z, lat, lon in set(sites):
        dist, i = min((math.sqrt((lat - a) ** 2 + (lon - b) ** 2), i) for q, a, b, i in points if q == z)
        assert got[z, lat, lon] == (pytest.approx(dist), i)
    assert not [name for name, plan, _ in written if "Window" in plan]
    assert max(rows for *_, rows in written) < 25 * len(points)


def test_nearest_pick_by_region_sorts_no_pairs(spark, written):
    """The query per region gives the sums of its links, and nothing on its way holds cells or pairs in sorted groups."""
    from gridvoice.plans import links
    from gridvoice.sources.conform import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    got = {r.region: (r.nb, r.nb_liees, r.distance_moyenne_km) for r in links.nearest_by_region(t).collect()}
    assert written and not [name for name, plan, _ in written if "Window" in plan]
    rows = correlation.link_nearest_incident(t.tickets, t.incidents).select("region", "incident_lie", "distance_incident_km").collect()
    for region in {r.region for r in rows}:
        own = [r for r in rows if r.region == region]
        far = [r.distance_incident_km for r in own if r.distance_incident_km is not None]
        linked = sum(r.incident_lie is not None for r in own)
        assert got[region] == (len(own), linked, pytest.approx(sum(far) / len(far)) if far else None)


def test_first_per_key_is_total_and_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 3), (1, None, 9), (2, "z", None), (None, "q", 1), (None, "p", 5)], "k int, o string, v int"
    )
    got = sorted(map(tuple, skew.first_per_key(df, ["k"], ["o"]).collect()), key=str)
    assert got == sorted([(1, None, 9), (2, "z", None), (None, "p", 5)], key=str)


def test_attach_group_stats_groups_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (None, "y"), (None, None)], "k int, t string")
    got = sorted((r.k, r.t, r.n) for r in skew.attach_group_stats(df, ["k", "t"], n=F.count(F.lit(1))).collect() if r.k)
    assert got == [(1, "x", 2), (1, "x", 2)]
    counts = sorted(r.n for r in skew.attach_group_stats(df, ["k", "t"], n=F.count(F.lit(1))).collect())
    assert counts == [1, 2, 2, 2, 2]


def test_broadcast_only_below_limit(spark):
    df = spark.range(1000)
    assert skew.estimated_bytes(df) > 0
    assert "broadcast" in skew.broadcast_if_small(df, 10**9)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in skew.broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString().lower()


def test_sequence_number_matches_window(spark):
    rows, rnd = hot_rows(400, 3)
    data = [(k, f"2024-01-{rnd.randrange(1, 5):02d} {rnd.randrange(24):02d}:00:00", i) for i, (k, _) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, at string, id int").withColumn("at", F.col("at").cast("timestamp"))
    got = {r.id: r.n for r in enrich.with_sequence_number(df, "k", "at", "id", "n").collect()}
    for key in {d[0] for d in data}:
        ordered = sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2]))
        assert [got[d[2]] for d in ordered] == list(range(1, len(ordered) + 1))


def test_readings_before_matches_pairs(spark):
    from datetime import date, datetime, timedelta

    rnd = random.Random(11)
    base = date(2024, 1, 1)
    readings = [(rnd.choice("MN"), base + timedelta(days=rnd.randrange(500)), rnd.randrange(100) * 1.0, rnd.random() < 0.5) for _ in range(300)]
    complaints = [
        (i, rnd.choice(["M", "N", "O", None]), datetime(2024, 1, 1) + timedelta(days=rnd.randrange(500), hours=rnd.randrange(24)))
        for i in range(80)
    ]
    r = spark.createDataFrame(readings, "reference_linky string, date_releve date, consommation_kwh double, anomalie_detectee boolean")
    c = spark.createDataFrame(complaints, "id int, reference_linky string, date_creation timestamp")
    got = {x.id: x for x in correlation.abnormal_readings_before(c, r).collect()}
    for i, meter, at in complaints:
        near = [k for m, d, k, bad in readings if bad and m == meter and 0 <= (at.date() - d).days <= 180]
        assert got[i].nb_anomalies_releves_6mois == len(near)
        if near:
            assert got[i].conso_moyenne_6mois == pytest.approx(sum(near) / len(near))
        else:
            assert got[i].conso_moyenne_6mois is None


def test_nearest_incident_boundaries(spark):
    complaints = spark.createDataFrame(
        [
            (1, "A", "2024-01-04 00:00:00", 0.0, 0.0),  # midnight three days later still counts
            (2, "A", "2024-01-04 00:00:01", 0.0, 0.0),
            (3, "A", "2023-12-31 23:59:59", 0.0, 0.0),  # before the incident
            (4, "A", "2024-01-02 10:00:00", None, None),  # no place: smallest id, null distance
            (5, "B", "2024-01-02 10:00:00", 0.0, 0.0),  # only an incident without a place
            (6, "A", "2024-01-01 00:00:00", 9.0, 9.0),
        ],
        "id_reclamation int, region string, at string, latitude double, longitude double",
    ).withColumn("date_creation", F.col("at").cast("timestamp"))
    incidents = spark.createDataFrame(
        [(10, "A", "2024-01-01", 3.0, 4.0), (9, "A", "2024-01-01", 3.0, 4.0), (8, "A", "2024-01-01", 8.0, 8.0), (7, "B", "2024-01-01", None, None)],
        "id_incident int, region string, d string, latitude double, longitude double",
    ).withColumn("date_incident", F.col("d").cast("date"))
    got = {r.id_reclamation: (r.incident_lie, r.distance_incident_km) for r in correlation.link_nearest_incident(complaints, incidents).collect()}
    assert got[1] == (9, pytest.approx(555.0))
    assert got[2] == (None, None)
    assert got[3] == (None, None)
    assert got[4] == (8, None)
    assert got[5] == (7, None)
    assert got[6] == (8, pytest.approx(math.sqrt(2) * 111))


def test_split_duplicates_adds_up(spark):
    df = spark.createDataFrame(
        [(1, 1, "2024-01-15 10:00:00", "C"), (2, 1, "2024-01-15 14:00:00", "C"), (3, 2, "2024-01-15 10:00:00", "L"), (4, 1, "2024-01-16 10:00:00", "C")],
        "id int, client_id int, at string, type_reclamation string",
    ).withColumn("date_creation", F.col("at").cast("timestamp"))
    kept, aside = cleaning.split_duplicates(df, cleaning.same_client_day_type(), "date_creation", "id")
    assert sorted(r.id for r in kept.collect()) == [1, 3, 4]
    assert [r.id for r in aside.collect()] == [2]


def test_seven_day_peaks_matches_brute_force(spark):
    from datetime import datetime, timedelta

    rnd = random.Random(5)
    start = datetime(2024, 1, 1)
    data = [(i, rnd.choice("AB"), start + timedelta(seconds=rnd.randrange(40 * 86400)), rnd.randrange(1, 9)) for i in range(200)]
    data += [(200, "A", start + timedelta(days=7), 3), (201, "A", start, 5)]
    df = spark.createDataFrame(data, "id int, region string, date_creation timestamp, nb_reclamations_zone_jour int")
    got = {r.id: r for r in anomaly.seven_day_peaks(df).collect()}
    for i, zone, at, volume in data:
        frame = [v for _, z, t, v in data if z == zone and timedelta(0) <= at - t <= timedelta(days=7)]
        mean = sum(frame) / len(frame)
        assert got[i].moyenne_7j == pytest.approx(mean)
        if len(frame) > 1:
            deviation = math.sqrt(sum((v - mean) ** 2 for v in frame) / (len(frame) - 1))
            assert got[i].ecart_type_7j == pytest.approx(deviation, abs=1e-6)
        else:
            assert got[i].ecart_type_7j is None


def test_incident_zone_matches_brute_force(spark):
    from datetime import datetime, timedelta

    rnd = random.Random(2)
    start = datetime(2024, 1, 1)
    complaints = [(i, round(rnd.uniform(0, 1), 2), round(rnd.uniform(0, 1), 2), start + timedelta(hours=rnd.randrange(2000))) for i in range(150)]
    incidents = []
    for i in range(40):
        day = (start + timedelta(days=rnd.randrange(80))).date()
        incidents.append((i, round(rnd.uniform(0, 1), 1), round(rnd.uniform(0, 1), 1), day, None if i % 4 == 0 else day + timedelta(days=3)))
    c = spark.createDataFrame(complaints, "id int, latitude double, longitude double, date_creation timestamp")
    n = spark.createDataFrame(incidents, "id_incident int, latitude double, longitude double, date_incident date, date_fin date")
    as_of = datetime(2024, 3, 1)
    got = {r.id: r.est_lie_incident for r in correlation.in_incident_zone(c, n, "2024-03-01 00:00:00").collect()}
    for i, lat, lon, at in complaints:
        expected = any(
            a - 0.1 <= lat <= a + 0.1
            and b - 0.1 <= lon <= b + 0.1
            and datetime(d.year, d.month, d.day) <= at <= (datetime(e.year, e.month, e.day) if e else as_of)
            for _, a, b, d, e in incidents
        )
        assert got[i] == expected, (i, lat, lon, at)
