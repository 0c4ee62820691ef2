"""Duplicates reported on arrival against the batch form, over one file, some and many."""

import random

import pytest
from pyspark.sql import functions as F

from gridvoice.streaming import arrivals, checks

SCHEMA = "id_reclamation long, client_id long, type_reclamation string, date_creation timestamp"


def rows(spark, days=2):
    rng = random.Random(8)
    data = [(k, rng.randrange(60), rng.choice("AB"), rng.randrange(0, days * 86400)) for k in range(900)]
    df = spark.createDataFrame(data, "id_reclamation long, client_id long, type_reclamation string, t long")
    return df.select("id_reclamation", "client_id", "type_reclamation", F.timestamp_seconds("t").alias("date_creation"))


def counts(df):
    return {tuple(r)[:3]: r["count"] for r in df.groupBy("client_id", "type_reclamation", "jour").count().collect()}


@pytest.mark.parametrize("files", [1, 4, 40])
def test_first_and_repeated_rows(few_partitions, tmp_path, files):
    spark = few_partitions
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows(spark).repartition(files).write.parquet(source)
    per_trigger = None if files == 40 else 1
    stream = checks.read_parquet_stream(spark, source, SCHEMA, per_trigger)
    arrivals.report(stream, out, state, "3 days").awaitTermination()
    told = spark.read.parquet(out)
    batch = rows(spark).withColumn("jour", F.to_date("date_creation"))
    assert told.count() == batch.count() == told.select("id_reclamation").distinct().count()
    everything = counts(batch)
    assert counts(told.filter("etat = 'PREMIERE'")) == dict.fromkeys(everything, 1)
    assert counts(told.filter("etat = 'REPETEE'")) == {k: n - 1 for k, n in everything.items() if n > 1}
    assert told.filter("etat = 'TARDIVE'").count() == 0


def test_rows_after_the_watermark_are_late(few_partitions, tmp_path):
    spark = few_partitions
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def put(values):
        df = spark.createDataFrame(values, "id_reclamation long, client_id long, type_reclamation string, t long")
        df = df.select("id_reclamation", "client_id", "type_reclamation", F.timestamp_seconds("t").alias("date_creation"))
        df.coalesce(1).write.mode("append").parquet(source)

    def run():
        arrivals.report(checks.read_parquet_stream(spark, source, SCHEMA, 1), out, state).awaitTermination()
        return {r["id_reclamation"]: r["etat"] for r in spark.read.parquet(out).collect()}

    put([(1, 1, "A", 100), (2, 1, "A", 200)])
    assert sorted(run().values()) == ["PREMIERE", "REPETEE"]
    put([(3, 1, "A", 300), (4, 9, "A", 10 * 86400)])
    got = run()
    assert (got[3], got[4]) == ("REPETEE", "PREMIERE")
    # ten days later: the key of client 1 is known from what was reported, that of client 5 is not
    put([(5, 1, "A", 400), (6, 5, "A", 500)])
    got = run()
    assert (got[5], got[6]) == ("REPETEE", "TARDIVE")
    assert run() == got


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)
