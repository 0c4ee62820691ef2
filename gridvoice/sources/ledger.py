"""Incremental loads: a ledger of the files that were read, committed together with their rows.

Rows are written to a folder of their own for each load (``lot``). What counts is the ledger, a published table of
(file, size, time, lot): a row is visible if the ledger has its file with its lot. So a load becomes visible by one step, a crash
before it leaves rows that nobody sees, and a file that changed replaces its own rows and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridvoice.functions.skew import broadcast_if_small
from gridvoice.sources import versions

FILE = "_metadata.file_path"


@dataclass(frozen=True)
class Load:
    """Files read by one load, and those of them that had been read before with other content."""

    lot: str | None
    files: int
    changed: int


def listed(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """``(fichier, taille, modifie, chemin)`` of the files of a folder; their content is not read.

    ``fichier`` is the name that rows carry, ``chemin`` the path to read, with the signs of a pattern escaped.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return files.select(
        F.col(FILE).alias("fichier"),
        F.col("length").alias("taille"),
        F.unix_micros("modificationTime").alias("modifie"),
        F.regexp_replace("path", r"([\[\]{}*?\\])", r"\\$1").alias("chemin"),
    )


def known(spark: SparkSession, root: str) -> DataFrame:
    schema = "fichier string, taille long, modifie long, lot string"
    if versions.current(spark, f"{root}/ledger") is None:
        return spark.createDataFrame([], schema)
    return versions.read(spark, f"{root}/ledger")


def load_new(
    spark: SparkSession,
    directory: str,
    root: str,
    read: Callable[[SparkSession, list[str]], DataFrame],
    pattern: str = "*",
) -> Load:
    """Read the files that are new or changed since the last load, and only those.

    ``read(spark, paths)`` gives their rows, as a file source does. Files that have vanished keep their rows.
    """
    before = known(spark, root)
    now = listed(spark, directory, pattern)
    fresh = now.join(broadcast_if_small(before), ["fichier", "taille", "modifie"], "left_anti").collect()
    if not fresh:
        return Load(None, 0, 0)
    lot = uuid.uuid4().hex
    rows = read(spark, [r["chemin"] for r in fresh]).select("*", F.col(FILE).alias("fichier"))
    rows.write.option("compression", "snappy").parquet(f"{root}/rows/lot={lot}")
    entries = spark.createDataFrame([(r["fichier"], r["taille"], r["modifie"], lot) for r in fresh], "fichier string, taille long, modifie long, lot string")
    kept = before.join(F.broadcast(entries.select("fichier")), "fichier", "left_anti")
    changed = before.join(F.broadcast(entries.select("fichier")), "fichier", "left_semi").count()
    versions.publish(kept.unionByName(entries), f"{root}/ledger", {"lot": lot}, min_rows=len(fresh))
    return Load(lot, len(fresh), changed)


def rows(spark: SparkSession, root: str) -> DataFrame:
    """The visible rows, with the columns ``fichier`` and ``lot``. Folders of lots without a visible file are not opened."""
    ledger = known(spark, root)
    lots = sorted(r["lot"] for r in ledger.select("lot").distinct().collect())
    if not lots:
        raise FileNotFoundError(f"nothing was loaded into {root}")
    found = spark.read.option("basePath", f"{root}/rows").parquet(*[f"{root}/rows/lot={lot}" for lot in lots])
    return found.join(broadcast_if_small(ledger.select("fichier", "lot")), ["fichier", "lot"], "left_semi")


def drop_unseen(spark: SparkSession, root: str) -> int:
    """Delete the folders of lots that have no visible file: of loads that failed, and of files that were all replaced."""
    lots = {r["lot"] for r in known(spark, root).select("lot").distinct().collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/rows")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    unseen = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().removeprefix("lot=") not in lots]
    return sum(bool(fs.delete(p, True)) for p in unseen)
