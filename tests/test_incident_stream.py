"""Incidents kept across batches against the batch operators applied window by window."""

import random
from datetime import datetime, timedelta

import pytest

from gridvoice.operators import clusters
from gridvoice.streaming import checks, incidents

SCHEMA = (
    "id_reclamation long, client_id long, type_reclamation string, statut string, region string, departement string, "
    "date_creation timestamp"
)
START = datetime(2024, 3, 1)
DAYS = 3


def complaints(seed=4):
    """Bursts of outage complaints in a few départements, some without one, in two regions."""
    rng = random.Random(seed)
    rows = []
    for burst in range(60):
        at = START + timedelta(minutes=rng.randrange(0, DAYS * 1440))
        departement = rng.choice(["01", "02", None])
        region = rng.choice(["N", "S"])
        for _ in range(rng.choice([2, 6, 12, 30])):
            moment = at + timedelta(seconds=rng.randrange(0, 3 * 3600))
            rows.append((len(rows), rng.randrange(40), "COUPURE_ELECTRIQUE", rng.choice(["OUVERT", "EN_COURS", "CLOTURE"]), region, departement, moment))
    return rows


def batch_form(spark, rows, limit):
    """``match_open_incidents`` and ``merge_incidents`` per window; a silence is looked at before each window and at the end."""
    frame = spark.createDataFrame(rows, SCHEMA)
    found = clusters.clusters(clusters.open_outages(frame), 4).collect()
    schema = clusters.clusters(clusters.open_outages(frame), 4).schema
    known, until, ends = {}, {}, {}
    columns = "incident_id string, date_detection timestamp, date_debut_incident timestamp, region string, departement string, "
    columns += "niveau_severite string, nb_clients_affectes long, nb_reclamations_liees long, statut string"

    def silence(moment):
        for i in known:
            if i not in ends and until[i] + incidents.SILENCE <= moment:
                ends[i] = until[i] + incidents.SILENCE
                known[i]["statut"] = "RESOLU"

    for window in sorted({c["fenetre_debut"] for c in found}):
        if window + incidents.WINDOW > limit:
            continue
        silence(window)
        state = spark.createDataFrame([tuple(k.values()) for k in known.values()], columns)
        now = spark.createDataFrame([c for c in found if c["fenetre_debut"] == window], schema)
        matched = clusters.match_open_incidents(now, state).coalesce(1).cache()
        merged = clusters.merge_incidents(matched, state).coalesce(1).collect()
        for m in matched.collect():
            until[m["incident_id"]] = window + incidents.WINDOW
        matched.unpersist()
        known = {r["incident_id"]: r.asDict() for r in merged}
    silence(limit)
    return {
        (i, k["departement"], k["date_debut_incident"], k["nb_clients_affectes"], k["nb_reclamations_liees"], k["statut"], ends.get(i))
        for i, k in known.items()
    }


def streamed(spark, source, out, state, delay):
    stream = checks.read_parquet_stream(spark, source, SCHEMA, per_trigger=1)
    found = checks.outage_clusters(stream, 4, delay)
    incidents.start(spark, incidents.track(found), out, state).awaitTermination()
    return spark.read.schema(incidents.CHANGES).parquet(out)


def write(spark, folder, parts):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def as_set(changes):
    kept = ["incident_id", "departement", "date_debut_incident", "nb_clients_affectes", "nb_reclamations_liees", "statut", "date_fin_incident"]
    return {tuple(r) for r in incidents.latest(changes).select(*kept).collect()}


#: The last file closes all windows before it: nothing of it is a cluster.
LAST = START + timedelta(days=DAYS + 12)


def closing(n):
    return [(10**6 + n, 1, "COUPURE_ELECTRIQUE", "OUVERT", "N", "99", LAST)]


def test_shuffled_files_in_many_batches_equal_the_batch_form(few_partitions, tmp_path):
    spark, rows = few_partitions, complaints()
    want = batch_form(spark, rows, LAST - timedelta(days=5))
    assert len(want) > 15 and {w[1] for w in want} == {"01", "02", "INCONNU"}
    assert {w[5] for w in want} == {"RESOLU"}
    mixed = rows[:]
    random.Random(1).shuffle(mixed)
    folder = str(tmp_path / "in")
    write(spark, folder, [mixed[k::6] for k in range(6)])
    write(spark, folder, [closing(0)])
    got = streamed(spark, folder, str(tmp_path / "out"), str(tmp_path / "state"), "5 days")
    assert as_set(got) == want


def test_restart_and_open_incidents(few_partitions, tmp_path):
    """Files in the order of time, read in two runs; what is still open at the end stays so."""
    spark, rows = few_partitions, sorted(complaints(9), key=lambda r: r[-1])
    limit = rows[-1][-1] - timedelta(hours=1)
    want = batch_form(spark, rows, limit)
    assert {w[5] for w in want} == {"RESOLU", "DETECTE"}
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    size = len(rows) // 5 + 1
    parts = [rows[k : k + size] for k in range(0, len(rows), size)]
    write(spark, folder, parts[:2])
    first = streamed(spark, folder, out, state, "1 hour").count()
    write(spark, folder, parts[2:])
    got = streamed(spark, folder, out, state, "1 hour")
    assert 0 < first < got.count()
    assert as_set(got) == want
    # a run without new files adds nothing
    n = got.count()
    assert streamed(spark, folder, out, state, "1 hour").count() == n


def test_null_departement_is_unknown_in_both_forms(spark):
    rows = [(k, k, "COUPURE_ELECTRIQUE", "OUVERT", "N", None, START) for k in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {r["departement"] for r in checks.outage_clusters(frame, 4).collect()} == {"INCONNU"}
    assert {r["departement"] for r in clusters.clusters(clusters.open_outages(frame), 4).collect()} == {"INCONNU"}


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_changes_are_versions_of_one_incident(spark):
    later = START + timedelta(hours=2)
    rows = [("01", "I", "N", START, START, 5, 6, "DETECTE", None, later), ("01", "I", "N", START, START, 9, 9, "RESOLU", later, later)]
    got = incidents.latest(spark.createDataFrame(rows, incidents.CHANGES)).first()
    assert (got["nb_clients_affectes"], got["statut"], got["date_fin_incident"]) == (9, "RESOLU", later)
