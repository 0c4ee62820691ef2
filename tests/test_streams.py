"""Streams over one file, a folder of parts and many files with mixed times agree with the batch form."""

import random

import pytest
from pyspark.sql import functions as F

from gridvoice.sources import versions
from gridvoice.streaming import checks

SCHEMA = "user_id long, date_creation timestamp, type_reclamation string, client_id long"


def rows(spark):
    rng = random.Random(5)
    times = [rng.randrange(0, 3 * 86400) for _ in range(4000)]
    data = [(k, t, rng.choice(["A", "B"]), k % 300) for k, t in enumerate(times)]
    df = spark.createDataFrame(data, "user_id long, t long, type_reclamation string, client_id long")
    return df.select("user_id", F.timestamp_seconds("t").alias("date_creation"), "type_reclamation", "client_id")


@pytest.mark.parametrize("files", [1, 4, 40])
@pytest.mark.parametrize("check", [checks.hourly_load, checks.daily_duplicates, checks.stable_windows])
def test_all_rows_are_counted(spark, tmp_path, files, check):
    path = str(tmp_path / "events.parquet")
    # a file holds times from all over the period
    rows(spark).repartition(files).write.parquet(path)
    if files == 1:
        path = next(str(p) for p in (tmp_path / "events.parquet").glob("part-*.parquet"))
    stream = checks.read_parquet_stream(spark, path, SCHEMA)
    checks.run_to_parquet(check(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = check(spark.read.schema(SCHEMA).parquet(path))
    end = batch.columns[1] if check is checks.stable_windows else batch.columns[0]
    # windows still open at the end of the stream are not emitted
    span = {"heure": "1 HOUR", "creation_day": "1 DAY", "fin": "0 HOUR"}[end]
    closed = batch.filter(F.expr(f"CAST({end} AS TIMESTAMP) + INTERVAL {span} <= TIMESTAMP_SECONDS({3 * 86400 - 3700})"))
    assert closed.exceptAll(got).count() == 0
    assert got.exceptAll(batch).count() == 0
    assert closed.count() > 0


def test_latest_totals_are_published_in_versions(spark, tmp_path):
    """Totals over files in four batches; a reader between them sees one whole batch, a repeated batch changes nothing."""
    path, root, state = (str(tmp_path / n) for n in ("events.parquet", "table", "state"))
    rows(spark).repartition(4).write.parquet(path)
    stream = checks.read_parquet_stream(spark, path, SCHEMA, per_trigger=1)
    latest = checks.latest_per_source(stream, "type_reclamation", "date_creation")
    checks.run_latest(latest, root, state).awaitTermination()
    expected = checks.latest_per_source(spark.read.parquet(path), "type_reclamation", "date_creation")
    before = versions.current(spark, root)
    reader = versions.read(spark, root)
    assert sorted(reader.collect()) == sorted(expected.collect())
    assert before.facts["batch"] == 3
    # the last commit is lost: the batch is delivered again
    commits = sorted((tmp_path / "state" / "commits").glob("*[0-9]"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    checks.run_latest(latest, root, state).awaitTermination()
    assert versions.current(spark, root) == before
    # more rows: a new version, while the reader stays on its own
    late = spark.createDataFrame([(9, "A", 1)], "user_id long, type_reclamation string, client_id long")
    late.coalesce(1).withColumn("date_creation", F.timestamp_seconds(F.lit(10 * 86400))).write.mode("append").parquet(path)
    checks.run_latest(latest, root, state).awaitTermination()
    assert versions.read(spark, root).agg(F.max(F.unix_timestamp("derniere"))).first()[0] == 10 * 86400
    assert reader.agg(F.max(F.unix_timestamp("derniere"))).first()[0] < 4 * 86400
