"""Incidents kept across stream batches: a cluster opens one, later clusters raise its counts, silence resolves it.

The clusters come from the windowed aggregation of ``checks.outage_clusters``; they are few, whatever the number of complaints. The
incidents of a département are kept in a state store (``transformWithState``) until they are resolved, with an event-time timer for the
silence. The rules are those of ``clusters.match_open_incidents`` and ``clusters.merge_incidents``, applied window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gridvoice.operators import clusters

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: An incident without a new cluster for so long after the end of its last window is resolved.
SILENCE = timedelta(hours=6)
WINDOW = timedelta(hours=2)

_HOUR = 3_600_000_000
# an open incident fits a cluster if it began at most so long before or after the cluster, in microseconds
_BEFORE, _AFTER = _HOUR, 2 * _HOUR
_WINDOW = WINDOW // timedelta(microseconds=1)

_MOMENTS = ["date_debut_incident", "date_detection", "date_fin_incident", "jusqu_a"]
_FIELDS = [
    "departement",
    "incident_id",
    "region",
    "date_debut_incident",
    "date_detection",
    "nb_clients_affectes",
    "nb_reclamations_liees",
    "statut",
    "date_fin_incident",
    "jusqu_a",
]
_TEXT = ("departement", "incident_id", "region", "statut")
_RAW = ", ".join(f"{c} {'string' if c in _TEXT else 'long'}" for c in _FIELDS)
CHANGES = ", ".join(f"{c} {'string' if c in _TEXT else 'timestamp' if c in _MOMENTS else 'long'}" for c in _FIELDS)
_KEPT = "region string, debut long, detection long, clients long, reclamations long, jusqu_a long"


class IncidentTracker(StatefulProcessor):
    """The open incidents of one département; moments are microseconds.

    What comes out depends on the clusters alone, not on how they are spread over batches: clusters are taken in the order
    of their windows, and an incident whose silence has ended before a window is resolved before that window is looked at.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "incident_id string", _KEPT)

    def _known(self) -> dict[str, list]:
        return {key[0]: list(value) for key, value in self.open.iterator()}

    def _change(self, departement: str, incident: str, kept: list, end: int | None = None) -> Row:
        region, start, detected, clients, complaints, until = kept
        state = "DETECTE" if end is None else "RESOLU"
        values = [departement, incident, region, start, detected, clients, complaints, state, end, until]
        return Row(**dict(zip(_FIELDS, values)))

    def _resolved(self, departement: str, known: dict[str, list], moment: int) -> Iterator[Row]:
        for incident in sorted(known):
            end = known[incident][5] + self.silence
            if end <= moment:
                yield self._change(departement, incident, known.pop(incident), end)
                self.open.removeKey((incident,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        departement = key[0]
        known = self._known()
        windows: dict[int, list[Row]] = {}
        for row in rows:
            windows.setdefault(row["fenetre"], []).append(row)
        for window in sorted(windows):
            yield from self._resolved(departement, known, window)
            until = window + _WINDOW
            raised: dict[str, list[Row]] = {}
            created: dict[str, list] = {}
            for found in sorted(windows[window], key=lambda r: str(r["region"])):
                start = found["debut"]
                fits = [i for i, kept in known.items() if start - _BEFORE <= kept[1] <= start + _AFTER]
                if fits:
                    raised.setdefault(min(fits), []).append(found)
                elif found["cle"] not in known and found["cle"] not in created:  # an id that exists is not entered again
                    counts = [found["nb_clients"], found["nb_reclamations"]]
                    created[found["cle"]] = [found["region"], start, found["fin"], *counts, until]
            for incident, touching in raised.items():
                kept = known[incident]
                kept[3] = max(kept[3], *(c["nb_clients"] for c in touching))
                kept[4] = max(kept[4], *(c["nb_reclamations"] for c in touching))
                kept[5] = until
            known |= created
            for incident in sorted(raised | created):
                self.open.updateValue((incident,), tuple(known[incident]))
                self.handle.registerTimer((until + self.silence) // 1000)
                yield self._change(departement, incident, known[incident])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._resolved(key[0], self._known(), expiredTimerInfo.getExpiryTimeInMs() * 1000)

    def close(self) -> None:
        pass


def track(found: DataFrame, silence: timedelta = SILENCE) -> DataFrame:
    """Changes of incidents, as rows to append: one when it is opened or touched by a window, one when it is resolved."""
    rows = found.select(
        "departement",
        F.col("region").cast("string").alias("region"),
        F.unix_micros("fenetre_debut").alias("fenetre"),
        F.unix_micros("debut_incident").alias("debut"),
        F.unix_micros("fin_periode").alias("fin"),
        "nb_clients",
        "nb_reclamations",
        clusters.incident_key().alias("cle"),
    )
    changes = rows.groupBy("departement").transformWithState(
        statefulProcessor=IncidentTracker(silence // timedelta(microseconds=1)),
        outputStructType=_RAW,
        outputMode="Append",
        timeMode="EventTime",
    )
    return changes.withColumns({c: F.timestamp_micros(c) for c in _MOMENTS})


def latest(changes: DataFrame) -> DataFrame:
    """The incidents as their last change left them: counts, last window and end only grow."""
    last = changes.groupBy("departement", "incident_id").agg(
        F.min("date_debut_incident").alias("date_debut_incident"),
        F.min("date_detection").alias("date_detection"),
        F.max("nb_clients_affectes").alias("nb_clients_affectes"),
        F.max("nb_reclamations_liees").alias("nb_reclamations_liees"),
        F.max("jusqu_a").alias("jusqu_a"),
        F.max("date_fin_incident").alias("date_fin_incident"),
    )
    return last.withColumn("statut", F.when(F.col("date_fin_incident").isNotNull(), "RESOLU").otherwise("DETECTE"))


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, beside the heap and on disk."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def start(spark: SparkSession, changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the changes to Parquet; processes what is there and stops. The state store must be RocksDB for this operator."""
    with state_in_rocksdb(spark):
        writer = changes.writeStream.format("parquet").outputMode("append").option("path", path)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
