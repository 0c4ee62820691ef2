"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridvoice.sources import scratch

#: Bytes of text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 1 << 20

#: Largest side, in bytes of its rows in memory, that is sent to every executor.
BROADCAST_BYTES = 64 << 20


#: Rows of one Arrow batch; texts can be long, and a task holds a batch on both sides.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_HELD: dict = {}


def small_batches(df: DataFrame) -> DataFrame:
    """The frame, with the session's Arrow batches limited to ``BATCH_ROWS`` rows if they are larger."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_SETTING, None) or 10_000) > BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def worker_copy(key, build):
    """What ``build`` makes, kept by the Python worker until another operator keeps something else."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def lower_ascii(text):
    """A-Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of one piece stay near ``limit`` bytes."""
    lengths = batch.column(column).cast(pa.large_string())
    sizes = pa.compute.fill_null(pa.compute.binary_length(lengths), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def broadcast_within(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a counted table only if it is within the bound; else it is shuffled."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder once and read it from there.

    It cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    return scratch.materialise(df, name)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, made longer until the frame has none of them, whatever the case of its own."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found
