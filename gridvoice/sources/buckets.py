"""Upserts into a bucketed table: the target is neither shuffled nor sorted, and only the buckets touched are rewritten.

The table is written with ``bucketBy`` on the keys, one file per bucket. An upsert shuffles the few incoming rows to the buckets and
joins them by a hash table, so the target is only scanned, and only the files of buckets that get rows are opened.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice.operators import merge
from gridvoice.sources import versions

JOURNAL = "_swap.json"


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table at a path; ``name`` is its entry in the session's catalog."""

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def files(self) -> dict[int, list[str]]:
        """Names of the data files by bucket."""
        fs, to_path = versions._files(self.spark, self.path)
        out: dict[int, list[str]] = {}
        for status in fs.listStatus(to_path(self.path)):
            found = re.search(r"_(\d+)\.c\d+[^/]*\.parquet$", status.getPath().getName())
            if found:
                out.setdefault(int(found.group(1)), []).append(status.getPath().getName())
        return out

    def bucket(self):
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def merged(self, source: DataFrame, update: Sequence[str], touched: Sequence[int]) -> DataFrame:
        """Target rows of the touched buckets with the source merged in."""
        files = self.files()
        names = [n for b in touched for n in files.get(b, [])]
        target = self.rows().filter(F.col("_metadata.file_name").isin(names) if names else F.lit(False))
        return merge.upsert(target, source.hint("shuffle_hash"), self.keys, update)

    def upsert(self, source: DataFrame, update: Sequence[str]) -> list[int]:
        """Insert new keys, change the ``update`` columns of known ones; returns the buckets that were rewritten.

        The source must be unique on the keys. New files are written aside, then moved in while the old ones are deleted; a journal lets the
        next call end a move that was cut off. A reader that lists files during the move may see a bucket twice: readers that must not
        use ``versions``.
        """
        self.recover()
        touched = sorted(r[0] for r in source.select(self.bucket()).distinct().collect())
        if not touched:
            return []
        old = self.files()
        aside = f"{self.path}/_new-{uuid.uuid4().hex}"
        write(self.merged(source, update, touched), aside, self.keys, self.buckets)
        fs, to_path = versions._files(self.spark, self.path)
        new = [s.getPath().getName() for s in fs.listStatus(to_path(aside)) if s.getPath().getName().endswith(".parquet")]
        journal = {"from": aside.rsplit("/", 1)[1], "move": new, "drop": [n for b in touched for n in old.get(b, [])]}
        versions.put_new(self.spark, f"{self.path}/{JOURNAL}", json.dumps(journal))
        self.recover()
        return touched

    def recover(self) -> None:
        """End a move of files that was begun; every step may be repeated."""
        text = versions.read_text(self.spark, f"{self.path}/{JOURNAL}")
        if text is not None:
            journal = json.loads(text)
            fs, to_path = versions._files(self.spark, self.path)
            for name in journal["drop"]:
                fs.delete(to_path(f"{self.path}/{name}"), False)
            for name in journal["move"]:
                fs.rename(to_path(f"{self.path}/{journal['from']}/{name}"), to_path(f"{self.path}/{name}"))
            fs.delete(to_path(f"{self.path}/{JOURNAL}"), False)
            fs.delete(to_path(f"{self.path}/{journal['from']}"), True)
        self.spark.catalog.refreshTable(self.name)


def write(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Bucket files at a path; the catalog entry that the writer needs is dropped, the files stay."""
    spark, name = df.sparkSession, f"aside_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("compression", "snappy").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def register(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> Bucketed:
    """A catalog entry for bucket files that are there."""
    name, listed = f"buckets_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    clustered = f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {clustered} LOCATION '{path}'")
    return Bucketed(spark, name, path, tuple(keys), buckets)


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> Bucketed:
    """A new bucketed table; the rows are dealt to the buckets first, so that each is one file."""
    write(df.repartition(buckets, *keys), path, keys, buckets)
    return register(df.sparkSession, path, df.schema, keys, buckets)


def buckets_for(bytes_estimated: int, each: int = 256 << 20) -> int:
    """As many buckets as give files of about ``each`` bytes; a power of two."""
    return 1 << max(0, (max(1, bytes_estimated) - 1).bit_length() - (each - 1).bit_length())
