"""Customer notices: missing ones and compliance with the communication deadlines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D


def _sent(notices: DataFrame, kind: str) -> DataFrame:
    return notices.filter((F.col("type_notification") == kind) & (F.col("statut") == "ENVOYE")).select("id_reclamation")


def _gap(kind: str, overdue: Column, late: Column) -> list[Column]:
    return [
        F.col("id_reclamation"),
        F.col("client_id"),
        F.lit(kind).alias("type_notification_manquante"),
        overdue.alias("echeance_depassee"),
        late.cast("double").alias("heures_de_retard"),
    ]


def missing_acknowledgements(complaints: DataFrame, notices: DataFrame) -> DataFrame:
    """Open past 80 % of the acknowledgement deadline without a sent acknowledgement."""
    kind, limit = "ACCUSE_RECEPTION", D.NOTICE_SLA["ACCUSE_RECEPTION"]
    open_for = F.coalesce("duree_heures", F.lit(0.0))
    rows = complaints.filter(C.is_open() & (open_for > limit * 0.8)).join(_sent(notices, kind), "id_reclamation", "left_anti")
    return rows.select(*_gap(kind, open_for > limit, F.greatest(F.lit(0.0), open_for - limit)))


def missing_resolution_notices(complaints: DataFrame, notices: DataFrame, run_date: str, days: int = 3) -> DataFrame:
    """Recently created and closed without a sent resolution notice."""
    kind, limit = "RESOLUTION_RECLAMATION", D.NOTICE_SLA["RESOLUTION_RECLAMATION"]
    recent = F.to_date("date_creation") >= F.date_sub(F.lit(run_date).cast("date"), days)
    rows = complaints.filter((F.col("statut") == "CLOTURE") & recent).join(_sent(notices, kind), "id_reclamation", "left_anti")
    late = F.greatest(F.lit(0.0), F.coalesce("duree_heures", F.lit(0.0)) - C.sla_limit() - limit)
    return rows.select(*_gap(kind, F.lit(True), late))


def missing_incident_notices(
    links: DataFrame, incidents: DataFrame, notices: DataFrame, run_date: str | None, as_of: str
) -> DataFrame:
    """Clients of an incident (of the day when given) without a notice sent after its detection.

    A later notice exists exactly when the client's latest one is later, so notices
    are reduced to one row per client and nothing multiplies.
    """
    kind, limit = "INCIDENT_SYSTEMIQUE", D.NOTICE_SLA["INCIDENT_SYSTEMIQUE"]
    since = C.hours_between(C.moment(as_of), "date_detection")
    due = incidents.filter(since > limit).select("incident_id", "date_detection")
    if run_date is not None:
        due = due.filter(F.to_date("date_detection") == F.lit(run_date).cast("date"))
    latest = (
        notices.filter(F.col("type_notification") == kind)
        .groupBy("client_id")
        .agg(F.max("date_envoi").alias("_latest"))
    )
    affected = links.join(due, "incident_id").join(latest, "client_id", "left")
    untold = affected.filter(F.col("_latest").isNull() | (F.col("_latest") < F.col("date_detection")))
    return untold.select(*_gap(kind, F.lit(True), since - limit))


def missing_notices(
    complaints: DataFrame,
    notices: DataFrame,
    links: DataFrame,
    incidents: DataFrame,
    run_date: str,
    as_of: str,
) -> DataFrame:
    parts = [
        missing_acknowledgements(complaints, notices),
        missing_resolution_notices(complaints, notices, run_date),
        missing_incident_notices(links, incidents, notices, run_date, as_of),
    ]
    return reduce(DataFrame.unionByName, parts)


def communication_sla(notices: DataFrame, day: str | None = None) -> DataFrame:
    """Compliance per notice type; types without notices keep a zero row."""
    rows = notices if day is None else notices.filter(F.to_date("created_at") == F.lit(day).cast("date"))
    met, total = F.count_if("dans_delai_legal"), F.count(F.lit(1))
    figures = rows.groupBy("type_notification").agg(
        total.alias("nb_total"),
        met.alias("nb_dans_delai"),
        (total - met).alias("nb_hors_delai"),
        C.rounded(C.rate(met, total), 2).alias("taux_conformite_pct"),
    )
    limits = notices.sparkSession.createDataFrame(
        list(D.NOTICE_SLA.items()), "type_notification string, sla_heures int"
    )
    return (
        limits.join(figures, "type_notification", "left")
        .fillna(0, ["nb_total", "nb_dans_delai", "nb_hors_delai"])
    )
