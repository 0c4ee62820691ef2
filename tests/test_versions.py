"""Reloading without a gap: failures, readers during a reload, and what is dropped."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from gridvoice.sources import versions


def numbers(spark, n, shift=0):
    return spark.range(n).select((F.col("id") + shift).alias("id"), (F.col("id") % 3).alias("part"))


def test_versions_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    first = versions.publish(numbers(spark, 10), root, {"batch": 1})
    assert (first.number, first.rows, versions.current(spark, root)) == (1, 10, first)
    second = versions.publish(numbers(spark, 4), root, {"batch": 2}, partition_by=["part"])
    assert versions.current(spark, root) == second and second.facts == {"batch": 2}
    assert versions.read(spark, root).count() == 4
    assert versions.read(spark, root, first).count() == 10


def test_failing_reload_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    first = versions.publish(numbers(spark, 10), root)
    broken = numbers(spark, 1000).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken row"):
        versions.publish(broken, root)
    with pytest.raises(versions.Rejected):
        versions.publish(numbers(spark, 3), root, min_rows=5)
    with pytest.raises(versions.Rejected):
        versions.publish(numbers(spark, 30), root, check=lambda df: df.filter("id > 100").count() > 0)
    assert versions.current(spark, root) == first
    assert versions.read(spark, root).count() == 10


def test_readers_see_one_version_each_during_reloads(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish(numbers(spark, 100, 0), root)
    stop, seen, failed = threading.Event(), [], []

    def reader():
        while not stop.is_set():
            try:
                rows = versions.read(spark, root)
                low, high, n = rows.agg(F.min("id"), F.max("id"), F.count("id")).first()
                again = rows.count()
                seen.append((low, high - low, n, again))
            except Exception as exc:
                failed.append(exc)

    threads = [threading.Thread(target=reader) for _ in range(2)]
    for t in threads:
        t.start()
    for k in range(1, 6):
        versions.publish(numbers(spark, 100, 1000 * k), root)
    time.sleep(0.5)
    stop.set()
    for t in threads:
        t.join()
    assert not failed
    # whole versions only: 100 rows from one multiple of 1000 on
    assert {(low % 1000, *rest) for low, *rest in seen} == {(0, 99, 100, 100)}
    assert len({low for low, *_ in seen}) > 1


def test_old_versions_are_dropped_by_rule(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(4):
        versions.publish(numbers(spark, k + 1), root)
    with pytest.raises(versions.Rejected):
        versions.publish(numbers(spark, 1), root, min_rows=2)
    assert [n for n, _ in versions.folders(spark, root)] == [1, 2, 3, 4, 5]
    assert versions.prune(spark, root, keep=2, min_age=3600) == []
    assert len(versions.prune(spark, root, keep=2)) == 3
    assert [n for n, _ in versions.folders(spark, root)] == [3, 4]
    assert versions.read(spark, root).count() == 4


def test_second_writer_of_one_number_fails(spark, tmp_path):
    root = str(tmp_path / "t")

    def overtaking(df):
        versions.publish(numbers(spark, 7), root)
        return True

    with pytest.raises(versions.Overtaken):
        versions.publish(numbers(spark, 3), root, check=overtaking)
    assert versions.read(spark, root).count() == 7
