"""Upserts into a bucketed table: results, plan, files left alone, and a move that was cut off."""

import re

import pytest
from pyspark.sql import functions as F

from gridvoice.operators import merge
from gridvoice.sources import buckets, versions

KEYS = ("day", "region")


def table(spark, n=400):
    return spark.range(n).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("day"),
        F.concat(F.lit("r"), F.floor(F.col("id") / 100)).alias("region"),
        F.col("id").alias("v"),
        F.lit("old").alias("w"),
    )


def changes(spark):
    few = table(spark).filter("v % 57 = 0").withColumns({"v": F.col("v") + 1000, "w": F.lit("new")})
    more = few.limit(2).withColumn("region", F.lit("r9"))
    return few.unionByName(more)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def made(spark, tmp_path):
    return buckets.create(table(spark), str(tmp_path / "t"), KEYS, 16)


def test_upsert_equals_the_frame_operator(spark, made):
    source = changes(spark)
    want = rows(merge.upsert(table(spark), source, KEYS, ["v"]))
    assert {len(f) for f in made.files().values()} == {1}
    before = made.files()
    touched = made.upsert(source, ["v"])
    assert 0 < len(touched) < 16 and rows(made.rows()) == want
    after = made.files()
    assert {b for b in range(16) if before.get(b) != after.get(b)} == set(touched)
    assert {len(f) for f in after.values()} == {1}
    made.upsert(source, ["v"])
    assert rows(made.rows()) == want
    # another session finds the table by its files
    again = buckets.register(spark, made.path, made.rows().schema, KEYS, 16)
    assert rows(again.rows()) == want


def test_target_is_neither_shuffled_nor_sorted(spark, made):
    merged = made.merged(changes(spark), ["v"], [0, 3, 5])
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    at = next(k for k, line in enumerate(lines) if "Bucketed: true" in line or re.search(r"SelectedBucketsCount", line))
    # the operators above the scan of the target, up to the join
    depth = lambda line: len(re.match(r"[\s:|]*", line).group(0))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    path = "\n".join(above)
    assert "ShuffledHashJoin" in path and "Exchange" not in path and not re.search(r"\bSort\b", path)
    opened = merged.inputFiles()
    assert opened


def test_only_files_of_touched_buckets_are_read(spark, made):
    files = made.files()
    kept = made.rows().filter(F.col("_metadata.file_name").isin(files[3] + files[5]))
    assert kept.select(made.bucket().alias("b")).distinct().count() == 2
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2


def test_a_move_that_was_cut_off_is_ended(spark, made, monkeypatch):
    source = changes(spark)
    want = rows(merge.upsert(table(spark), source, KEYS, ["v"]))
    put = versions.put_new

    def cut(*args):
        put(*args)
        raise RuntimeError("power cut")

    monkeypatch.setattr(versions, "put_new", cut)
    with pytest.raises(RuntimeError):
        made.upsert(source, ["v"])
    monkeypatch.setattr(versions, "put_new", put)
    made.recover()
    assert rows(made.rows()) == want
    made.recover()
    assert rows(made.rows()) == want


def test_number_of_buckets():
    assert [buckets.buckets_for(b) for b in (0, 1 << 20, 256 << 20, 257 << 20, 1 << 40)] == [1, 1, 1, 2, 4096]
