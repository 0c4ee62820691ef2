"""Incremental loads: nothing is read twice, changed files replace their rows, a crash repeats without copies."""

import os

import pytest

from gridvoice.sources import ledger, versions


def read(spark, paths):
    return spark.read.schema("k int, v string").csv(paths)


def put(folder, name, text, at):
    path = folder / name
    path.write_text(text)
    os.utime(path, (at, at))


def visible(spark, root):
    return sorted((r["k"], r["v"]) for r in ledger.rows(spark, root).collect())


@pytest.fixture
def place(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put(source, "a.csv", "1,a\n2,b\n", 1_000)
    put(source, "b [c].csv", "3,c\n", 1_000)
    return source, str(tmp_path / "table")


def test_second_run_reads_nothing_and_new_files_are_added(spark, place):
    source, root = place
    opened = []

    def watched(spark, paths):
        opened.append(len(paths))
        return read(spark, paths)

    assert ledger.load_new(spark, str(source), root, watched).files == 2
    assert ledger.load_new(spark, str(source), root, watched) == ledger.Load(None, 0, 0)
    put(source, "d.csv", "4,d\n", 2_000)
    assert ledger.load_new(spark, str(source), root, watched).files == 1
    assert opened == [2, 1]
    assert visible(spark, root) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_changed_file_replaces_its_own_rows(spark, place):
    source, root = place
    ledger.load_new(spark, str(source), root, read)
    put(source, "a.csv", "1,z\n5,e\n", 3_000)
    again = ledger.load_new(spark, str(source), root, read)
    assert (again.files, again.changed) == (1, 1)
    assert visible(spark, root) == [(1, "z"), (3, "c"), (5, "e")]
    # same size, other time: read again; a file that vanished keeps its rows
    put(source, "a.csv", "1,y\n5,e\n", 4_000)
    (source / "b [c].csv").unlink()
    assert ledger.load_new(spark, str(source), root, read).files == 1
    assert visible(spark, root) == [(1, "y"), (3, "c"), (5, "e")]
    assert ledger.drop_unseen(spark, root) == 1
    assert visible(spark, root) == [(1, "y"), (3, "c"), (5, "e")]


def test_crash_between_rows_and_commit(spark, place, monkeypatch):
    source, root = place
    ledger.load_new(spark, str(source), root, read)
    put(source, "d.csv", "4,d\n", 2_000)
    publish = versions.publish

    def crash(*args, **kwargs):
        raise RuntimeError("power cut")

    monkeypatch.setattr(versions, "publish", crash)
    with pytest.raises(RuntimeError):
        ledger.load_new(spark, str(source), root, read)
    assert visible(spark, root) == [(1, "a"), (2, "b"), (3, "c")]
    monkeypatch.setattr(versions, "publish", publish)
    assert ledger.load_new(spark, str(source), root, read).files == 1
    assert visible(spark, root) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert ledger.drop_unseen(spark, root) == 1


def test_nothing_loaded_yet(spark, place):
    with pytest.raises(FileNotFoundError):
        ledger.rows(spark, place[1])
