"""Field interventions: unplanned work, urgency and technician load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C

FIELD_TYPES = ["COUPURE_ELECTRIQUE", "RACCORDEMENT_RESEAU", "INTERVENTION_TECHNIQUE", "COMPTEUR_LINKY"]
DAY_HOURS = 8.0
DEFAULT_JOB_HOURS = 2.0


def hours_before_deadline() -> Column:
    return C.sla_limit(default=240) - F.coalesce("duree_heures", F.lit(0.0))


def urgency() -> Column:
    """1 most urgent to 5: outage, connection with under 72 h left, technical work, meter, others."""
    kind = F.col("type_reclamation")
    return (
        F.when(kind == "COUPURE_ELECTRIQUE", 1)
        .when((kind == "RACCORDEMENT_RESEAU") & (hours_before_deadline() < 72), 2)
        .when(kind == "INTERVENTION_TECHNIQUE", 3)
        .when(kind == "COMPTEUR_LINKY", 4)
        .otherwise(5)
    )


def active_work(interventions: DataFrame) -> DataFrame:
    """Interventions neither cancelled nor done; filtered before any join."""
    return interventions.filter(~F.col("statut").isin("ANNULEE", "REALISEE"))


def unplanned(complaints: DataFrame, interventions: DataFrame, run_date: str) -> DataFrame:
    """Open field complaints without active work, with hours left and urgency."""
    rows = complaints.filter(C.is_open() & F.col("type_reclamation").isin(FIELD_TYPES))
    waiting = rows.join(active_work(interventions).select("id_reclamation"), "id_reclamation", "left_anti")
    return waiting.select(
        "id_reclamation",
        "type_reclamation",
        "region",
        "departement",
        hours_before_deadline().alias("heures_avant_sla"),
        urgency().alias("priorite_calculee"),
        F.lit(run_date).cast("date").alias("date_identification"),
    )


def technician_load(interventions: DataFrame, day: str | None = None) -> DataFrame:
    """Planned and urgent jobs, hours and percentage of an eight-hour day."""
    rows = interventions.filter(F.col("technicien_id").isNotNull())
    if day is not None:
        rows = rows.filter(F.col("date_planifiee") == F.lit(day).cast("date"))
    hours = F.sum(F.coalesce("duree_estimee_h", F.lit(DEFAULT_JOB_HOURS)))
    return (
        rows.groupBy(F.col("date_planifiee").alias("date_calcul"), "technicien_id", "zone_intervention", "departement")
        .agg(
            F.count_if(F.col("statut") == "PLANIFIEE").alias("nb_interventions_planifiees"),
            F.count_if(F.col("priorite") <= 2).alias("nb_interventions_urgentes"),
            hours.alias("charge_heures"),
            C.rounded(100.0 * hours / DAY_HOURS, 2).alias("taux_charge_pct"),
        )
        .withColumn("disponible", F.col("taux_charge_pct") < 100)
    )


def dispatch_report(queue: DataFrame) -> DataFrame:
    return (
        queue.groupBy("departement")
        .agg(
            F.count(F.lit(1)).alias("nb_non_planifiees"),
            F.min("heures_avant_sla").alias("min_heures_avant_sla"),
            F.count_if(F.col("priorite_calculee") == 1).alias("urgents"),
        )
        .orderBy(F.desc("urgents"), "min_heures_avant_sla", "departement")
    )
