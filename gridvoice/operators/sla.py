"""Deadlines: limits, compliance, breaches, risk, and the type-specific detail tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.operators import enrich

SEVERE_BREACHES = 50
SEVERE_RISKS = 100


def with_limit(df: DataFrame, default: int | None = D.SLA_DEFAULT) -> DataFrame:
    return df.withColumn("sla_heures", C.sla_limit(default=default))


def with_compliance(df: DataFrame, limit: str | Column = "sla_heures") -> DataFrame:
    """Closed: duration within the limit. Open: unknown."""
    closed = F.col("date_cloture").isNotNull()
    return df.withColumn("sla_respect", F.when(closed, F.col("duree_heures") <= C.col(limit)))


def with_hours_left(df: DataFrame) -> DataFrame:
    return df.withColumn("heures_restantes", F.when(C.is_open(), F.col("sla_heures") - F.col("duree_heures")))


def with_breach_risk(df: DataFrame, hours: int | Column) -> DataFrame:
    """Open and between zero and ``hours`` hours left."""
    left = F.col("heures_restantes")
    return df.withColumn("risque_depassement", F.coalesce(C.is_open() & (left >= 0) & (left < hours), F.lit(False)))


def detail(complaints: DataFrame, kind: str, as_of: str) -> DataFrame:
    """Complaints of one type with elapsed time and all deadline columns."""
    rows = complaints.filter(F.col("type_reclamation") == kind)
    rows = with_limit(enrich.with_elapsed(rows, as_of))
    return with_breach_risk(with_hours_left(with_compliance(rows)), D.RISK_HOURS[kind])


def details(complaints: DataFrame, sources: Mapping[str, str], as_of: str) -> DataFrame:
    """``detail`` of several types in one scan; ``source`` names the detail table of each type."""
    rows = complaints.filter(F.col("type_reclamation").isin(*sources))
    rows = with_limit(enrich.with_elapsed(rows, as_of))
    hours = C.case("type_reclamation", {kind: D.RISK_HOURS[kind] for kind in sources})
    rows = with_breach_risk(with_hours_left(with_compliance(rows)), hours)
    return rows.withColumn("source", C.case("type_reclamation", dict(sources)))


def breaches(df: DataFrame) -> DataFrame:
    """Not closed and past the limit, with the overrun. Expects ``duree_heures`` and ``sla_heures``."""
    over = F.col("duree_heures") - F.col("sla_heures")
    return df.filter((F.col("statut") != "CLOTURE") & (over > 0)).withColumn("depassement_heures", over)


def at_risk(df: DataFrame, hours: int = 24) -> DataFrame:
    """Open with at most ``hours`` left, already overdue ones included."""
    left = F.col("sla_heures") - F.col("duree_heures")
    return df.filter(C.is_open() & (left <= hours)).withColumn("temps_restant_heures", left)


def compliance(df: DataFrame, as_of: str | Column) -> DataFrame:
    """Compliance per region and type over closed complaints."""
    within = F.col("duree_traitement_heures") <= C.sla_limit()
    total = F.count(F.lit(1))
    return (
        df.filter(F.col("duree_traitement_heures").isNotNull())
        .groupBy("region", "type_reclamation")
        .agg(
            total.alias("total_reclamations"),
            F.count_if(within).alias("nb_conformes"),
            F.count_if(~within).alias("nb_non_conformes"),
            C.rate(F.count_if(within), total).alias("taux_conformite"),
        )
        .withColumn("date_calcul", C.day(as_of))
    )


def alert_level() -> Column:
    """Imminent, then out of deadline, then under a fifth of the time left, else nominal."""
    return (
        F.when(F.col("risque_depassement"), "RISQUE_IMMINENT")
        .when(F.col("duree_heures") > F.col("sla_heures"), "HORS_SLA")
        .when(F.col("heures_restantes") < F.col("sla_heures") * 0.2, "EN_VIGILANCE")
        .otherwise("NOMINAL")
    )


def alert_summary(df: DataFrame) -> DataFrame:
    """Number of breaches and at-risk complaints with the resulting status, as one row."""
    left = F.col("sla_heures") - F.col("duree_heures")
    late = F.count_if((F.col("statut") != "CLOTURE") & (left < 0))
    risky = F.count_if(C.is_open() & (left <= 24))
    return df.agg(
        late.alias("nb_depassements"),
        risky.alias("nb_a_risque"),
        F.when(late > SEVERE_BREACHES, "ALERTE").otherwise("NORMAL").alias("statut_sla"),
        (risky > SEVERE_RISKS).alias("alerte_risque"),
    )


# ---- type-specific details ------------------------------------------------------


def contested_per_meter(invoices: DataFrame) -> DataFrame:
    """Contested amount and smallest reason per meter, so the join below cannot fan out.

    Money is summed in decimals: the total does not depend on the task order.
    """
    return (
        invoices.filter("est_contestee")
        .groupBy("reference_linky")
        .agg(
            F.sum(F.col("montant_ttc").cast("decimal(24,6)")).cast("double").alias("montant_conteste"),
            F.min("motif_contestation").alias("type_erreur_facturation"),
        )
    )


def billing_detail(complaints: DataFrame, invoices: DataFrame | None, as_of: str) -> DataFrame:
    """Billing complaints with the contested amount; null columns when there are no invoices."""
    rows = detail(complaints, "FACTURATION", as_of)
    if invoices is None:
        return rows.withColumns(
            {
                "montant_conteste": F.lit(None).cast("double"),
                "type_erreur_facturation": F.lit(None).cast("string"),
            }
        )
    return rows.join(contested_per_meter(invoices), "reference_linky", "left")


def planned_work(interventions: DataFrame) -> DataFrame:
    """Earliest planned intervention per complaint."""
    first = F.min(F.struct("date_planifiee", "technicien_id", "zone_intervention"))
    return (
        interventions.filter(F.col("statut") == "PLANIFIEE")
        .groupBy("id_reclamation")
        .agg(first.alias("p"))
        .select(
            "id_reclamation",
            F.col("p.technicien_id").alias("technicien_id"),
            F.col("p.zone_intervention").alias("zone_intervention"),
            F.col("p.date_planifiee").alias("date_intervention_prevue"),
        )
    )


def connection_detail(complaints: DataFrame, interventions: DataFrame, as_of: str) -> DataFrame:
    rows = detail(complaints, "RACCORDEMENT_RESEAU", as_of)
    return enrich.with_planned_flag(rows.join(planned_work(interventions), "id_reclamation", "left"))


def billing_metrics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("montant_conteste").alias("montant_total"),
        F.avg("montant_conteste").alias("montant_moyen"),
        F.count_if(~F.col("sla_respect") & F.col("date_cloture").isNotNull()).alias("hors_sla"),
        F.count_if("risque_depassement").alias("en_risque"),
    )


def planning_report(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("intervention_planifiee").alias("avec_planification"),
            F.count_if(~F.col("intervention_planifiee")).alias("sans_planification"),
            F.count_if("risque_depassement").alias("en_risque_sla"),
            C.rounded(F.avg("duree_heures"), 1).alias("duree_moyenne_h"),
        )
        .orderBy(F.desc("en_risque_sla"), F.desc("total"), "region")
    )


def outage_alerts(df: DataFrame) -> DataFrame:
    overdue = C.is_open() & (F.col("duree_heures") > F.col("sla_heures"))
    return df.agg(F.count_if(overdue).alias("depassements"), F.count_if("risque_depassement").alias("risques"))
