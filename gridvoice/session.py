"""Session settings sized from the data."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

PARTITION_BYTES = 256 * 1024**2
MIN_PARTITIONS = 8


def shuffle_partitions(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Shuffle partitions that keep one partition near ``partition_bytes``.

    Adaptive execution merges small partitions but cannot add any beyond the first
    number, so the first number must fit the largest shuffle.
    """
    return max(MIN_PARTITIONS, math.ceil(input_bytes / partition_bytes))


def settings(input_bytes: int) -> dict[str, str]:
    """Settings for a job that reads about ``input_bytes``. No master is set here."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions(input_bytes)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.parquet.compression.codec": "snappy",
    }


def session(name: str, input_bytes: int, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**settings(input_bytes), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
