"""The seven-day frame against a plain computation, and its cost on a dense week."""

import random
import statistics
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridvoice.operators import anomaly

WEEK = 7 * 86400


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id long, region string, s long")
    return df.select("id", "region", F.timestamp_seconds("s").alias("date_creation"))


def test_frames_match(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["A", "B", None]), rng.randrange(30 * 86400)) for k in range(400)]
    rows += [(1000 + k, "A", rows[k][2] + WEEK) for k in range(0, 400, 7)] + [(2000, "A", rows[0][2]), (2001, "A", rows[0][2])]
    volume = Counter((z, s // 86400) for _, z, s in rows)
    got = {r["id"]: r for r in anomaly.seven_day_peaks(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, zone, s in rows:
        values = [volume[z, t // 86400] for _, z, t in rows if z == zone and s - WEEK <= t <= s]
        assert got[k]["moyenne_7j"] == pytest.approx(statistics.mean(values))
        if len(values) > 1:
            assert got[k]["ecart_type_7j"] == pytest.approx(statistics.stdev(values), abs=1e-6)


def test_a_dense_week_is_linear(spark):
    def seconds(n):
        df = spark.range(n).select("id", F.lit("A").alias("region"), F.timestamp_seconds(F.col("id") * 3).alias("date_creation"))
        began = time.perf_counter()
        anomaly.seven_day_peaks(df).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds(2_000)
    small, large = seconds(16_000), seconds(160_000)
    # a frame recomputed for every row would take a hundred times as long
    assert large < 20 * small + 10
