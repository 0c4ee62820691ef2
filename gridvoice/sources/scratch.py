"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# Paths handed out by this process that drop_all may delete.
_MADE: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local master."""
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="gridvoice-")
    spark.conf.set(SETTING, root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_all(spark: SparkSession) -> int:
    """Delete the intermediate tables this process made; call it when their results are no longer read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _MADE:
        path = hadoop(_MADE.pop())
        dropped += bool(path.getFileSystem(configuration).delete(path, True))
    return dropped


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    For small results that several branches of a query use: the inputs are scanned
    once, and a lost executor costs no recomputation of the branches.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
