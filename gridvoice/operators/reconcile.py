"""Consistency between complaint, field and billing systems, and delivery points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.operators.merge import upsert

CHECKED_TYPES = ["COUPURE_ELECTRIQUE", "RACCORDEMENT_RESEAU", "INTERVENTION_TECHNIQUE"]


def _not_reported(rows: DataFrame, known: DataFrame | None, kind: str, key: str = "id_reclamation") -> DataFrame:
    """Leave out what already has an open report of this kind."""
    if known is None:
        return rows
    open_ = known.filter((F.col("type_incoherence") == kind) & (F.col("statut") == "OUVERTE")).select(key)
    return rows.join(open_, key, "left_anti")


def _finding(kind: str, source: str, target: str, severity: Column, expected: Column, found: Column) -> list[Column]:
    return [
        F.lit(kind).alias("type_incoherence"),
        F.lit(source).alias("systeme_source"),
        F.lit(target).alias("systeme_cible"),
        F.col("id_reclamation"),
        F.col("client_id"),
        expected.alias("valeur_source"),
        found.alias("valeur_cible"),
        severity.alias("severite"),
    ]


def closed_with_open_work(complaints: DataFrame, interventions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Complaint closed while field work is planned or under way (one row per piece of work)."""
    kind = "CRM_OMEGA_STATUT"
    work = interventions.filter(F.col("statut").isin("PLANIFIEE", "EN_COURS")).select(
        "id_reclamation", F.col("statut").alias("_s"), F.col("priorite").alias("_p")
    )
    closed = complaints.filter(F.col("statut") == "CLOTURE").select("id_reclamation", "client_id")
    rows = _not_reported(closed, known, kind).join(work, "id_reclamation")
    return rows.select(
        *_finding(
            kind,
            "CRM",
            "OMEGA",
            F.when(F.col("_p") <= 2, "ELEVEE").otherwise("MODEREE"),
            F.lit("CRM:CLOTURE"),
            F.concat(F.lit("OMEGA:"), F.col("_s")),
        )
    )


def overdue_billing(complaints: DataFrame, known: DataFrame | None = None, hours: int = 240) -> DataFrame:
    """Billing complaint open for more than ``hours``."""
    kind = "SAP_CRM_FACTURE"
    rows = complaints.filter(
        (F.col("type_reclamation") == "FACTURATION") & C.is_open() & (F.coalesce("duree_heures", F.lit(0.0)) > hours)
    )
    return _not_reported(rows, known, kind).select(
        *_finding(
            kind, "SAP", "CRM", F.lit("ELEVEE"), F.lit("SAP:correction_possible"), F.concat(F.lit("CRM:"), F.col("statut"))
        )
    )


def work_not_created(complaints: DataFrame, interventions: DataFrame, known: DataFrame | None = None, hours: int = 4) -> DataFrame:
    """Field complaint open for more than ``hours`` without any intervention."""
    kind = "DELAI_SYNC_CRM_OMEGA"
    rows = complaints.filter(
        C.is_open()
        & F.col("type_reclamation").isin(CHECKED_TYPES)
        & (F.coalesce("duree_heures", F.lit(0.0)) > hours)
    ).join(interventions.select("id_reclamation"), "id_reclamation", "left_anti")
    outage = F.col("type_reclamation") == "COUPURE_ELECTRIQUE"
    return _not_reported(rows, known, kind).select(
        *_finding(
            kind,
            "CRM",
            "OMEGA",
            F.when(outage, "CRITIQUE").otherwise("ELEVEE"),
            F.lit("CRM: réclamation créée"),
            F.lit("OMEGA: aucune intervention"),
        )
    )


def work_without_complaint(interventions: DataFrame, complaints: DataFrame) -> DataFrame:
    """Field work done that no complaint asked for."""
    done = interventions.filter(F.col("statut") == "REALISEE")
    return done.join(complaints.select("id_reclamation"), "id_reclamation", "left_anti")


def all_findings(complaints: DataFrame, interventions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    parts = [
        closed_with_open_work(complaints, interventions, known),
        overdue_billing(complaints, known),
        work_not_created(complaints, interventions, known),
    ]
    return reduce(DataFrame.unionByName, parts)


CONTROLS = {"CRM_OMEGA_STATUT": "CRM_OMEGA", "SAP_CRM_FACTURE": "SAP_CRM", "DELAI_SYNC_CRM_OMEGA": "DELAI_SYNC"}


def coherence_log(complaints: DataFrame, findings: DataFrame) -> DataFrame:
    """Checked rows, findings and coherence percentage per control, in one pass over each input."""
    closed = (F.col("statut") == "CLOTURE") & F.col("type_reclamation").isin(CHECKED_TYPES)
    counts = complaints.agg(
        F.count_if(closed).alias("CRM_OMEGA"),
        F.count_if(F.col("type_reclamation") == "FACTURATION").alias("SAP_CRM"),
        F.lit(0).cast("long").alias("DELAI_SYNC"),
    )
    rows = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in CONTROLS.values()])
    checked = counts.select(F.explode(rows).alias("r")).select(
        F.col("r.c").alias("type_controle"), F.col("r.n").alias("_v"), F.lit(0).cast("long").alias("_i")
    )
    found = findings.groupBy(C.case("type_incoherence", CONTROLS).alias("type_controle")).agg(
        F.lit(0).cast("long").alias("_v"), F.count(F.lit(1)).alias("_i")
    )
    both = checked.unionByName(found).groupBy("type_controle").agg(F.sum("_v").alias("v"), F.sum("_i").alias("i"))
    return both.select(
        "type_controle",
        F.col("v").alias("nb_verifies"),
        F.col("i").alias("nb_incoherences"),
        C.rounded(100.0 * (F.col("v") - F.col("i")) / F.greatest(F.col("v"), F.lit(1)), 2).alias("taux_coherence_pct"),
    )


# ---- delivery points -------------------------------------------------------------


def points_from_meters(detail: DataFrame, complaints: DataFrame, run_date: str) -> DataFrame:
    """Delivery points seen on the day, one row per point (smallest place when it has several)."""
    rows = detail.filter(
        F.col("numero_compteur").isNotNull() & (F.col("export_date") == F.lit(run_date).cast("date"))
    ).select("id_reclamation", F.col("numero_compteur").alias("pdl_id"))
    places = complaints.select("id_reclamation", "region", "departement")
    return (
        rows.join(places, "id_reclamation")
        .groupBy("pdl_id")
        .agg(F.min(F.struct("departement", "region")).alias("_p"))
        .select(
            "pdl_id",
            F.col("_p.departement").alias("departement"),
            F.col("_p.region").alias("region"),
            F.lit("ACTIF").alias("statut_pdl"),
            F.lit(run_date).cast("date").alias("date_derniere_maj"),
        )
    )


def sync_points(points: DataFrame, seen: DataFrame) -> DataFrame:
    """Bring the reference list up to date: place and date change, status is kept."""
    return upsert(points, seen, ["pdl_id"], ["departement", "region", "date_derniere_maj"])


def complaint_links(detail: DataFrame, complaints: DataFrame, run_date: str) -> DataFrame:
    """Complaint → delivery point of the day."""
    rows = detail.filter(
        F.col("numero_compteur").isNotNull() & (F.col("export_date") == F.lit(run_date).cast("date"))
    ).select("id_reclamation", F.col("numero_compteur").alias("pdl_id"))
    return rows.join(complaints.select("id_reclamation", "client_id"), "id_reclamation").withColumn(
        "concerne_pdl", F.lit(True)
    )


def unknown_points(links: DataFrame, points: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Linked points missing from the reference list and not reported yet."""
    rows = links.filter(F.col("pdl_id").isNotNull()).join(points.select("pdl_id"), "pdl_id", "left_anti")
    rows = _not_reported(rows, known, "PDL_INCONNU", "pdl_id")
    return rows.select("pdl_id", "id_reclamation", F.lit("PDL_INCONNU").alias("type_incoherence"))


def double_assignments(history: DataFrame) -> DataFrame:
    """Points with several current clients."""
    return (
        history.filter("is_current")
        .groupBy("pdl_id")
        .agg(F.count_distinct("client_id").alias("nb_clients"))
        .filter(F.col("nb_clients") > 1)
    )


def point_findings(links: DataFrame, points: DataFrame, history: DataFrame, known: DataFrame | None = None) -> DataFrame:
    doubles = double_assignments(history).select(
        "pdl_id", F.lit(None).cast("long").alias("id_reclamation"), F.lit("DOUBLE_AFFECTATION").alias("type_incoherence")
    )
    return unknown_points(links, points, known).unionByName(doubles)


def moved_clients(links: DataFrame, history: DataFrame) -> DataFrame:
    """Complaints on a point outside every period in which their client held it."""
    held = history.select(
        F.col("pdl_id").alias("_p"), F.col("client_id").alias("_c"), F.col("date_debut").alias("_from"), F.col("date_fin").alias("_to")
    )
    created = F.to_date("date_creation")
    on = (
        (F.col("pdl_id") == F.col("_p"))
        & (F.col("client_id") == F.col("_c"))
        & (created >= F.col("_from"))
        & (F.col("_to").isNull() | (created <= F.col("_to")))
    )
    return links.join(held, on, "left_anti")


def point_stats(points: DataFrame, findings: DataFrame) -> DataFrame:
    """Number of points, active points and open findings, as one row."""
    zero = F.lit(0).cast("long")
    totals = points.agg(
        F.count(F.lit(1)).alias("total_pdl"),
        F.count_if(F.col("statut_pdl") == "ACTIF").alias("pdl_actifs"),
        zero.alias("incoherences_ouvertes"),
    )
    open_ = findings.agg(
        zero.alias("total_pdl"), zero.alias("pdl_actifs"), F.count(F.lit(1)).alias("incoherences_ouvertes")
    )
    both = totals.unionByName(open_)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])
