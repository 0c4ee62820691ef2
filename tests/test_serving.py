"""A serving table kept from a stream: equal to the batch form, and a repeated batch changes nothing."""

import random

import pytest
from pyspark.sql import functions as F

from gridvoice.sources import versions
from gridvoice.streaming import checks, serving

SCHEMA = "user_id long, date_creation timestamp, type_reclamation string"


def events(spark, n=3000):
    rng = random.Random(6)
    data = [(k, rng.randrange(0, 2 * 86400), rng.choice(["A", "B"])) for k in range(n)]
    df = spark.createDataFrame(data, "user_id long, t long, type_reclamation string")
    return df.select("user_id", F.timestamp_seconds("t").alias("date_creation"), "type_reclamation")


def rows(df):
    return sorted(map(tuple, df.select("heure", "volume", "niveau_charge").collect()))


@pytest.mark.parametrize("files", [1, 5])
def test_update_mode_equals_batch(spark, tmp_path, files):
    path, root, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    events(spark).repartition(files).write.parquet(path)
    stream = checks.read_parquet_stream(spark, path, SCHEMA, per_trigger=1)
    load = checks.hourly_load(stream, 1000, delay="3 days")
    serving.serve(load, root, ["heure"], state).awaitTermination()
    assert rows(versions.read(spark, root)) == rows(checks.hourly_load(spark.read.parquet(path), 1000))
    assert versions.current(spark, root).facts["batches"]["stream"] >= files - 1
    assert len(versions.folders(spark, root)) <= 2


def test_repeated_batches_change_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    apply = serving.merge_batch(root, ["k"])

    def batch(pairs):
        return spark.createDataFrame(pairs, "k string, n long")

    apply(batch([("a", 1), ("b", 1)]), 0)
    apply(batch([("a", 2), ("c", 1)]), 1)
    before = versions.current(spark, root)
    apply(batch([("a", 2), ("c", 1)]), 1)
    apply(batch([("a", 99)]), 0)
    assert versions.current(spark, root) == before
    assert sorted(map(tuple, versions.read(spark, root).collect())) == [("a", 2), ("b", 1), ("c", 1)]
    # another stream into the same table counts its own batches
    serving.merge_batch(root, ["k"], "other")(batch([("d", 5)]), 0)
    assert versions.read(spark, root).count() == 4
    assert versions.current(spark, root).facts["batches"] == {"stream": 1, "other": 0}


def test_a_batch_is_repeated_after_a_crash_before_the_commit(spark, tmp_path):
    path, root, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    events(spark, 500).repartition(1).write.parquet(path)

    def run(fails):
        apply = serving.merge_batch(root, ["heure"])

        def batch_then_crash(batch, number):
            apply(batch, number)
            if fails:
                raise RuntimeError("power cut")

        load = checks.hourly_load(checks.read_parquet_stream(spark, path, SCHEMA), 1000, delay="3 days")
        query = load.writeStream.outputMode("update").foreachBatch(batch_then_crash).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="power cut"):
        run(True)
    first = versions.current(spark, root)
    run(False)
    assert rows(versions.read(spark, root)) == rows(checks.hourly_load(spark.read.parquet(path), 1000))
    assert first.number == 1
