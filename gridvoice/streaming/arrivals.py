"""Duplicates reported when they arrive, not when their day is over.

The first complaint of a client, type and day passes a state store (``dropDuplicatesWithinWatermark``); each batch then holds all its rows
beside its first ones, so that the others can be told apart at once. Results are written per batch, and a batch that is
delivered again replaces its own rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridvoice.sources import readers
from gridvoice.streaming.incidents import state_in_rocksdb

#: A key is remembered this long after its first row: a day, and an hour of lateness.
DELAY = "25 hours"
KEY = ["client_id", "type_reclamation", "jour"]
FIRST, REPEATED, LATE = "PREMIERE", "REPETEE", "TARDIVE"


def arrivals(complaints: DataFrame, identity: str = "id_reclamation", at: str = "date_creation", delay: str = DELAY) -> DataFrame:
    """All rows, and once more those that are the first of their key (``_first``)."""
    dated = complaints.withColumn("jour", F.to_date(at)).withWatermark(at, delay).select(identity, *KEY, at)
    first = dated.dropDuplicatesWithinWatermark(KEY).withColumn("_first", F.lit(True))
    return dated.withColumn("_first", F.lit(False)).unionByName(first)


def separate(batch: DataFrame, earlier: DataFrame | None, identity: str = "id_reclamation", at: str = "date_creation") -> DataFrame:
    """The rows of a batch with their state.

    A row that is not first is repeated if its key has a first row, in this batch or an earlier one. Otherwise it came after its
    day was given up by the watermark: it is late, and nothing is known about its key.
    """
    columns = [identity, *KEY, at]
    firsts = batch.filter("_first").select(columns)
    others = batch.filter("NOT _first").join(firsts.select(identity), identity, "left_anti").select(columns)
    keys = firsts.select(KEY)
    if earlier is not None:
        keys = keys.unionByName(earlier.filter(F.col("etat") == FIRST).select(KEY))
    keys = keys.distinct().withColumn("_seen", F.lit(True))
    told = others.join(keys, KEY, "left").withColumn("etat", F.when(F.col("_seen"), REPEATED).otherwise(LATE))
    return firsts.withColumn("etat", F.lit(FIRST)).unionByName(told.drop("_seen"))


def report(complaints: DataFrame, path: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Write the state of every row at its arrival to ``path``, a folder per batch and day."""

    def apply(batch: DataFrame, number: int) -> None:
        # read several times, and all of it is needed for the state stores
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            earlier = readers.optional_parquet(batch.sparkSession, path)
            if earlier is not None:
                # only days that this batch has can hold its keys; the batch itself may have been written before
                days = [r[0] for r in batch.select("jour").distinct().collect()]
                earlier = earlier.filter((F.col("lot") != number) & F.col("jour").isin(days))
            told = separate(batch, earlier).withColumn("lot", F.lit(number))
            writer = told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lot", "jour")
            writer.parquet(path)
        finally:
            batch.unpersist()

    writer = arrivals(complaints, delay=delay).writeStream.outputMode("append").foreachBatch(apply)
    # a key for every client, type and day: more than a heap holds
    with state_in_rocksdb(complaints.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
