"""Serving tables kept current from a stream: each batch is merged once, however often it is delivered."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gridvoice.operators import merge
from gridvoice.sources import versions


def merge_batch(root: str, keys: Sequence[str], stream: str = "stream", keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that upserts a batch into the published table at ``root``.

    The number of the last batch is published with the rows, in one step. A batch that comes again, after a restart between the publishing
    and the stream's own commit, has a number that the table already has and changes nothing. Readers see whole batches.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = versions.current(spark, root)
        done = dict(now.facts.get("batches", {})) if now else {}
        if number <= done.get(stream, -1):
            batch.write.format("noop").mode("overwrite").save()  # the stream's state stores must be written all the same
            return
        rows = batch
        if now is not None:
            table = versions.read(spark, root, now)
            rows = merge.upsert(table, batch, keys, [c for c in batch.columns if c not in keys])
        versions.publish(rows, root, {"batches": done | {stream: number}})
        versions.prune(spark, root, keep, min_age=0 if keep > 1 else 60)

    return apply


def serve(
    stream: DataFrame, root: str, keys: Sequence[str], checkpoint: str, name: str = "stream", available_now: bool = True
) -> StreamingQuery:
    """Keep the totals of a stream as a table: rows of the update mode replace those of the same keys."""
    writer = (
        stream.writeStream.outputMode("update").foreachBatch(merge_batch(root, keys, name)).option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
