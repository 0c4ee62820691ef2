"""Registered queries on streams that are not run by ``run_to_parquet``, on events with bursts, against their SQL twins."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import crosscheck
import pytest

from gridvoice.plans import registry
from gridvoice.plans import streams  # noqa: F401  registers the queries
from gridvoice.sources import scratch
from gridvoice.streaming import incidents

SMALLEST = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def directory(spark, tmp_path_factory):
    """Events in bursts of one region each, some of which go on in the next window; the other tables as they are."""
    rng = random.Random(3)
    rows = []
    for _ in range(40):
        at = datetime(2024, 1, 2) + timedelta(minutes=rng.randrange(0, 5 * 1440))
        region = rng.randrange(5)
        for _ in range(rng.choice([3, 12, 30, 60])):
            moment = at + timedelta(seconds=rng.randrange(0, 2 * 3600))
            user = 5 * rng.randrange(25) + region
            rows.append((len(rows), moment, user, rng.choice(["click", "click", "error", "purchase", "signup"]), 1.0, "{}"))
    folder = tmp_path_factory.mktemp("bursts")
    for table in SMALLEST.iterdir():
        if table.name != "events.parquet":
            (folder / table.name).symlink_to(table)
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / "parts"))
    next((folder / "parts").glob("part-*.parquet")).rename(folder / "events.parquet")
    return str(folder)


def matches(spark, directory, name):
    ok, n, _, note = crosscheck.compare(
        spark, crosscheck.duck(directory), name, registry.QUERIES[name], registry.oracles()[name], directory
    )
    assert ok, note
    assert n > 0


def test_incidents(spark, directory):
    matches(spark, directory, "j19_stream_incidents")
    found = registry.QUERIES["j19_stream_incidents"](spark, directory).collect()
    assert {r["statut"] for r in found} == {"RESOLU", "DETECTE"}


def test_duplicates_on_arrival(spark, directory):
    """Equal to the SQL; the state of the keys is beside the heap."""
    folders = len(scratch._MADE)
    matches(spark, directory, "st4_duplicates_on_arrival")
    (root,) = [p for p in scratch._MADE[folders:] if "st4_arrivals" in p]
    assert incidents.ROCKSDB in (Path(root) / "checkpoint/offsets/0").read_text()
    assert spark.conf.get(incidents.PROVIDER) != incidents.ROCKSDB
