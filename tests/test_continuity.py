"""Continuity indices from one row per place and client, against a plain version."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from gridvoice.operators import regulatory

ROWS = (
    "id_reclamation long, client_id long, region string, departement string, type_reclamation string, "
    "duree_heures double, date_creation timestamp, export_date date"
)
RUN = dt.date(2024, 3, 1)


def complaints(seed, n=600):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        # one client has a third of all rows, some rows have none
        client = 1 if rng.random() < 0.33 else rng.choice([None, *range(2, 60)])
        region = rng.choice("AB")
        kind = rng.choice(["COUPURE_ELECTRIQUE", "FACTURATION"])
        hours = rng.choice([None, rng.randrange(0, 400) / 8])
        made = dt.datetime(2024, 3, 1) - dt.timedelta(days=rng.randrange(0, 800))
        out.append((k, client, region, region + rng.choice("123"), kind, hours, made, RUN - dt.timedelta(days=rng.randrange(2))))
    return out + [(n, 70, "C", "C1", "COUPURE_ELECTRIQUE", 3.0, dt.datetime(2020, 1, 1), RUN)]


def plain(rows):
    base, outages = defaultdict(set), defaultdict(list)
    for row in rows:
        _, client, region, departement, kind, hours, made, exported = row
        if client is not None and made >= dt.datetime(2024, 3, 1) - dt.timedelta(days=365):
            base[region].add(client)
        if kind == "COUPURE_ELECTRIQUE" and exported == RUN:
            outages[region, departement].append((client, hours or 0.0))
    out = {}
    for (region, departement), found in outages.items():
        hours, hit = sum(h for _, h in found), len({c for c, _ in found if c is not None})
        n = len(base[region])
        out[region, departement] = (
            hours * 60 * hit / n if n else 0.0,
            hit / n if n else 0.0,
            hours * 60 if hit else 0.0,
            hit,
            len(found),
            hours,
        )
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_a_plain_version(spark, seed):
    rows = complaints(seed)
    clients = regulatory.interruptions_per_client(spark.createDataFrame(rows, ROWS), "2024-03-01 00:00:00", str(RUN))
    got = {
        (r.region, r.departement): (
            r.saidi_minutes, r.saifi_index, r.caidi_minutes, r.nb_clients_affectes, r.nb_interruptions, r.duree_totale_interruption_h
        )
        for r in regulatory.continuity(clients, str(RUN)).collect()
    }
    expected = plain(rows)
    assert set(got) == set(expected)
    for place, values in expected.items():
        assert got[place] == pytest.approx(values, abs=1e-3)
    assert got["C", "C1"][:2] == (0.0, 0.0)


def test_the_complaints_are_aggregated_once(spark):
    """No row is expanded for distinct counts: one partial and one final hash aggregation."""
    clients = regulatory.interruptions_per_client(spark.createDataFrame(complaints(3), ROWS), "2024-03-01 00:00:00", str(RUN))
    plan = clients._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_no_complaints(spark):
    clients = regulatory.interruptions_per_client(spark.createDataFrame([], ROWS), "2024-03-01 00:00:00", str(RUN))
    assert regulatory.continuity(clients, str(RUN)).count() == 0
