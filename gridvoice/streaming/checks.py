"""Load, outage clusters, freshness, duplicates and recovery on a stream of complaints.

All of them are event-time aggregations with a watermark: a window is emitted
once, when the watermark has passed its end, and rows older than the watermark
are dropped. State is bounded by the watermark delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.operators import clusters, monitoring
from gridvoice.sources import versions

DELAY = "1 hour"


def read_parquet_stream(spark: SparkSession, path: str, schema, per_trigger: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream.

    Without ``per_trigger`` a replay reads all files that are there as one batch. A number of files per batch
    is only right for files in the order of event time: the watermark of one batch drops older rows of the next.

    The path is given as a pattern that only it matches: Spark takes a plain path for a folder, and a table
    may be a single file.
    """
    path = path.rstrip("/")
    stream = spark.readStream.schema(schema)
    if per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", per_trigger)
    return stream.parquet(f"{path[:-1]}[{path[-1]}]")


def hourly_load(complaints: DataFrame, per_day: int = D.BASELINE_PER_DAY, delay: str = DELAY) -> DataFrame:
    """Volume per hour with its load level."""
    per_hour = (
        complaints.withWatermark("date_creation", delay)
        .groupBy(F.window("date_creation", "1 hour").alias("_w"))
        .agg(F.count(F.lit(1)).alias("volume"))
    )
    return monitoring.with_load(per_hour.select(F.col("_w.start").alias("heure"), "volume"), per_day=per_day)


def outage_clusters(
    complaints: DataFrame, min_clients: int = D.CLUSTER_MIN_CLIENTS, delay: str = DELAY
) -> DataFrame:
    """Two-hour outage clusters per département with the exact number of distinct clients.

    Distinct counts are not allowed on streams, so clients are first aggregated per
    window and then counted: two chained windowed aggregations.

    Time goes on with all complaints, not only with open outages: their silence must end windows too. So the
    others are not filtered (Spark moves a filter below the watermark) but merged to one group per window and département.
    """
    outage = F.coalesce((F.col("type_reclamation") == "COUPURE_ELECTRIQUE") & C.is_open(), F.lit(False))
    marked = (
        complaints.withWatermark("date_creation", delay)
        .withColumn("departement", clusters.known_departement())
        .withColumn("_outage", outage)
        .withColumn("_client", F.when(F.col("_outage"), F.col("client_id")))
    )
    per_client = marked.groupBy(
        F.window("date_creation", clusters.WINDOW).alias("window"), "region", "departement", "_outage", "_client"
    ).agg(
        F.count_if("_outage").alias("_n"),
        F.min(F.when(F.col("_outage"), F.col("date_creation"))).alias("_first"),
        F.max(F.when(F.col("_outage"), F.col("date_creation"))).alias("_last"),
    )
    found = per_client.groupBy("window", "region", "departement").agg(
        F.count("_client").alias("nb_clients"),
        F.sum("_n").alias("nb_reclamations"),
        F.min("_first").alias("debut_incident"),
        F.max("_last").alias("fin_periode"),
    )
    return found.filter(F.col("nb_clients") >= min_clients).select(
        "region",
        "departement",
        F.col("window.start").alias("fenetre_debut"),
        "nb_clients",
        "nb_reclamations",
        "debut_incident",
        "fin_periode",
    )


def latest_per_source(rows: DataFrame, source: str, at: str) -> DataFrame:
    """Newest timestamp per source, for update or complete output."""
    return rows.groupBy(source).agg(F.max(at).alias("derniere"))


def daily_duplicates(complaints: DataFrame, delay: str = DELAY) -> DataFrame:
    """Several complaints of the same client and type on one day."""
    return (
        complaints.withWatermark("date_creation", delay)
        .groupBy(F.window("date_creation", "1 day").alias("_w"), "client_id", "type_reclamation")
        .agg(F.count(F.lit(1)).alias("nb_reclamations"))
        .filter(F.col("nb_reclamations") > 1)
        .select(F.to_date("_w.start").alias("creation_day"), "client_id", "type_reclamation", "nb_reclamations")
    )


def stable_windows(complaints: DataFrame, per_day: int = D.BASELINE_PER_DAY, delay: str = DELAY) -> DataFrame:
    """Two-hour windows every hour, stable when both halves stay below the critical level."""
    critical = min(bound for bound, name, _ in D.LOAD_LEVELS if name == "CRITIQUE")
    slid = complaints.withWatermark("date_creation", delay).select(
        "date_creation", F.window("date_creation", "2 hours", "1 hour").alias("window")
    )
    middle = F.col("window.start") + F.expr("INTERVAL 1 HOUR")
    halves = slid.groupBy("window").agg(
        F.count_if(F.col("date_creation") < middle).alias("premiere_heure"),
        F.count_if(F.col("date_creation") >= middle).alias("seconde_heure"),
    )
    busiest = F.greatest("premiere_heure", "seconde_heure")
    return halves.select(
        F.col("window.start").alias("debut"),
        F.col("window.end").alias("fin"),
        "premiere_heure",
        "seconde_heure",
        (monitoring.load_ratio(busiest, per_day) < critical).alias("stable"),
    )


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append emitted rows to Parquet; ``available_now`` processes what is there and stops."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def run_latest(stream: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep a small table of the current totals at ``root``: every batch is published as a version.

    Readers see the totals of one batch, never a table that is being written. A batch that comes again changes nothing.
    """

    def replace(batch: DataFrame, number: int) -> None:
        now = versions.current(batch.sparkSession, root)
        if now is not None and number <= now.facts.get("batch", -1):
            batch.write.format("noop").mode("overwrite").save()  # the stream's state stores must be written all the same
            return
        versions.publish(batch, root, {"batch": number})
        versions.prune(batch.sparkSession, root, 2)

    writer = stream.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
