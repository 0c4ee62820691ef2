"""Outage clusters and the incidents built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.operators.anomaly import severity_rank

WINDOW = "2 hours"
CLUSTER = ["region", "departement", "fenetre_debut"]
SEVERITY_ORDER = ["CRITIQUE", "MAJEUR", "MODERE"]


def known_departement() -> Column:
    return F.coalesce("departement", F.lit("INCONNU"))


def open_outages(complaints: DataFrame, run_date: str | None = None) -> DataFrame:
    """Open outage complaints (of one day when given) with their two-hour window start."""
    rows = complaints.filter((F.col("type_reclamation") == "COUPURE_ELECTRIQUE") & C.is_open())
    if run_date is not None:
        rows = rows.filter(F.to_date("date_creation") == F.lit(run_date).cast("date"))
    window = F.window("date_creation", WINDOW)
    return rows.withColumn("_w", window).select(
        "id_reclamation",
        "client_id",
        "region",
        known_departement().alias("departement"),
        "date_creation",
        F.col("_w.start").alias("fenetre_debut"),
    )


def clusters(outages: DataFrame, min_clients: int = D.CLUSTER_MIN_CLIENTS) -> DataFrame:
    """Windows with enough distinct clients, with counts and time span. Complaint ids are unique.

    Member ids are kept as rows (see :func:`members`), never as an array: a storm
    window may hold a large share of all complaints.
    """
    return (
        outages.groupBy(*CLUSTER)
        .agg(
            F.count_distinct("client_id").alias("nb_clients"),
            F.count(F.lit(1)).alias("nb_reclamations"),
            F.min("date_creation").alias("debut_incident"),
            F.max("date_creation").alias("fin_periode"),
        )
        .filter(F.col("nb_clients") >= min_clients)
    )


def severity(n: str | Column = "nb_clients") -> Column:
    return C.banded(n, D.CLUSTER_SEVERITY, D.CLUSTER_SEVERITY_DEFAULT)


def incident_key() -> Column:
    return F.format_string(
        "INC-%s-%s-%04d", "departement", F.date_format("fenetre_debut", "yyyyMMddHH"), F.col("nb_clients")
    )


def by_size(found: DataFrame) -> DataFrame:
    return found.orderBy(F.desc("nb_clients"), *CLUSTER)


def match_open_incidents(found: DataFrame, incidents: DataFrame) -> DataFrame:
    """Give each cluster the open incident of its département starting in [start − 1 h, start + 2 h], if any.

    The range is turned into an equality on the hour: a cluster looks up the four
    hours it can touch. The smallest incident id wins.
    """
    known = incidents.filter(F.col("statut") != "RESOLU").select(
        F.col("departement").alias("_dept"),
        F.col("date_debut_incident").alias("_start"),
        F.date_trunc("hour", "date_debut_incident").alias("_hour"),
        F.col("incident_id").alias("_known"),
    )
    start = F.col("debut_incident")
    low, high = start - F.expr("INTERVAL 1 HOUR"), start + F.expr("INTERVAL 2 HOURS")
    hours = F.sequence(F.date_trunc("hour", low), F.date_trunc("hour", high), F.expr("INTERVAL 1 HOUR"))
    touched = found.select(*CLUSTER, "debut_incident", F.explode(hours).alias("_slot"))
    on = (F.col("departement") == F.col("_dept")) & (F.col("_slot") == F.col("_hour")) & F.col("_start").between(low, high)
    matches = touched.join(known, on).groupBy(*CLUSTER).agg(F.min("_known").alias("_known"))
    return found.join(matches, CLUSTER, "left").withColumn("incident_id", F.coalesce("_known", incident_key())).withColumn(
        "existant", F.col("_known").isNotNull()
    ).drop("_known")


def merge_incidents(matched: DataFrame, incidents: DataFrame) -> DataFrame:
    """Raise the counts of known incidents to their clusters' maximum and add the new incidents."""
    per_incident = matched.filter("existant").groupBy("incident_id").agg(
        F.max("nb_clients").alias("_c"), F.max("nb_reclamations").alias("_r")
    )
    updated = incidents.join(per_incident, "incident_id", "left").select(
        *[
            F.greatest("nb_clients_affectes", "_c").alias(c)
            if c == "nb_clients_affectes"
            else F.greatest("nb_reclamations_liees", "_r").alias(c)
            if c == "nb_reclamations_liees"
            else F.col(c)
            for c in incidents.columns
        ]
    )
    created = matched.filter(~F.col("existant")).select(
        "incident_id",
        F.col("fin_periode").alias("date_detection"),
        F.col("debut_incident").alias("date_debut_incident"),
        "region",
        "departement",
        severity().alias("niveau_severite"),
        F.col("nb_clients").alias("nb_clients_affectes"),
        F.col("nb_reclamations").alias("nb_reclamations_liees"),
        F.lit("DETECTE").alias("statut"),
    )
    fresh = created.join(incidents.select("incident_id"), "incident_id", "left_anti")
    return updated.unionByName(fresh)


def members(outages: DataFrame, matched: DataFrame) -> DataFrame:
    """Complaint ↔ incident links of the clusters, without duplicates."""
    return (
        outages.select("id_reclamation", "client_id", *CLUSTER)
        .join(matched.select(*CLUSTER, "incident_id"), CLUSTER)
        .select("id_reclamation", "client_id", "incident_id")
        .distinct()
    )


def refresh_severity(incidents: DataFrame) -> DataFrame:
    running = F.col("statut").isin("DETECTE", "EN_COURS")
    return incidents.withColumn(
        "niveau_severite", F.when(running, severity("nb_clients_affectes")).otherwise(F.col("niveau_severite"))
    )


def resolve_finished(incidents: DataFrame, links: DataFrame, complaints: DataFrame, as_of: str) -> DataFrame:
    """Mark running incidents without any open linked complaint as resolved."""
    busy = (
        links.select("id_reclamation", "incident_id")
        .join(complaints.filter(C.is_open()).select("id_reclamation"), "id_reclamation", "left_semi")
        .select("incident_id")
        .distinct()
        .withColumn("_busy", F.lit(True))
    )
    done = F.col("statut").isin("DETECTE", "EN_COURS") & F.col("_busy").isNull()
    joined = incidents.join(busy, "incident_id", "left")
    return joined.select(
        *[F.when(done, "RESOLU").otherwise(F.col(c)).alias(c) if c == "statut" else F.col(c) for c in incidents.columns],
        F.when(done, C.moment(as_of)).alias("date_fin_incident"),
    )


def report(incidents: DataFrame, day: str | None = None) -> DataFrame:
    rows = incidents if day is None else incidents.filter(F.to_date("date_detection") == F.lit(day).cast("date"))
    return (
        rows.groupBy("niveau_severite", "statut")
        .agg(F.count(F.lit(1)).alias("nb"), F.sum("nb_clients_affectes").alias("clients"))
        .orderBy(severity_rank("niveau_severite", SEVERITY_ORDER), "statut")
    )
