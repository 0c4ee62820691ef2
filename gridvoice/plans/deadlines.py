"""Deadline compliance, breaches, risk and the specialised detail tables."""

from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.operators import enrich, kpi, sla
from gridvoice.plans.registry import query
from gridvoice.sources.conform import AS_OF, register_sql_view

SLA_CASE = (
    "CASE type_reclamation WHEN 'COUPURE_ELECTRIQUE' THEN 48 WHEN 'COMPTEUR_LINKY' THEN 120 WHEN 'FACTURATION' THEN 240 "
    "WHEN 'RACCORDEMENT_RESEAU' THEN 360 WHEN 'INTERVENTION_TECHNIQUE' THEN 168 ELSE {0} END"
)

register_sql_view(
    "timed",
    f"""SELECT *, date_diff('second', date_creation, coalesce(date_cloture, TIMESTAMP '{AS_OF}')) / 3600.0::DOUBLE AS duree_heures,
      date_diff('second', date_creation, date_cloture) / 3600.0::DOUBLE AS duree_traitement_heures,
      date_diff('second', date_creation, date_premiere_reponse) / 3600.0::DOUBLE AS delai_premiere_reponse_heures,
      {SLA_CASE.format(168)} AS sla_heures FROM tickets""",
)


def detail_sql(kind: str, hours: int) -> str:
    return f"""SELECT *, CASE WHEN date_cloture IS NOT NULL THEN duree_heures <= sla_heures END AS sla_respect,
      CASE WHEN statut IN ('OUVERT', 'EN_COURS') THEN sla_heures - duree_heures END AS heures_restantes,
      statut IN ('OUVERT', 'EN_COURS') AND sla_heures - duree_heures >= 0 AND sla_heures - duree_heures < {hours} AS risque_depassement
      FROM timed WHERE type_reclamation = '{kind}'"""


register_sql_view("outage_detail", detail_sql("COUPURE_ELECTRIQUE", 12))
register_sql_view("billing_base", detail_sql("FACTURATION", 24))
register_sql_view("connection_base", detail_sql("RACCORDEMENT_RESEAU", 48))
register_sql_view(
    "contested",
    """SELECT reference_linky, sum(montant_ttc::DECIMAL(24,6))::DOUBLE AS montant_conteste, min(motif_contestation) AS type_erreur_facturation
      FROM invoices WHERE est_contestee GROUP BY 1""",
)
register_sql_view(
    "billing_detail",
    "SELECT b.*, montant_conteste, type_erreur_facturation FROM billing_base b LEFT JOIN contested c ON b.reference_linky = c.reference_linky",
)
register_sql_view(
    "planned_work",
    """SELECT id_reclamation, technicien_id, zone_intervention, date_planifiee AS date_intervention_prevue FROM interventions
      WHERE statut = 'PLANIFIEE'
      QUALIFY row_number() OVER (PARTITION BY id_reclamation ORDER BY date_planifiee, technicien_id, zone_intervention) = 1""",
)
register_sql_view(
    "connection_detail",
    """SELECT b.*, technicien_id, zone_intervention, date_intervention_prevue,
        technicien_id IS NOT NULL AND date_intervention_prevue IS NOT NULL AS intervention_planifiee
      FROM connection_base b LEFT JOIN planned_work p ON b.id_reclamation = p.id_reclamation""",
)


def timed(t):
    return sla.with_limit(enrich.with_elapsed(t.complaints, AS_OF))


def closed_durations(t):
    return enrich.with_durations(t.tickets)


@query(
    "p05_sla_limit",
    f"""SELECT type_reclamation, min({SLA_CASE.format(168)}) AS sla_heures, count(*) AS nb FROM tickets GROUP BY 1""",
)
def sla_limits(t):
    return sla.with_limit(t.complaints).groupBy("type_reclamation").agg(
        F.min("sla_heures").alias("sla_heures"), F.count(F.lit(1)).alias("nb")
    )


@query(
    "p06_sla_met",
    """SELECT id_reclamation, CASE WHEN date_cloture IS NOT NULL THEN duree_heures <= sla_heures END AS sla_respect FROM timed""",
)
def sla_met(t):
    return sla.with_compliance(timed(t)).select("id_reclamation", "sla_respect")


@query(
    "p07_hours_left",
    """SELECT id_reclamation, round(CASE WHEN statut IN ('OUVERT', 'EN_COURS') THEN sla_heures - duree_heures END, 4) AS heures_restantes FROM timed""",
)
def hours_left(t):
    return sla.with_hours_left(timed(t)).select("id_reclamation", "heures_restantes")


@query(
    "p08_breach_risk",
    """SELECT id_reclamation, type_reclamation, round(heures_restantes, 4) AS heures_restantes FROM (
      SELECT * FROM outage_detail UNION ALL SELECT * FROM billing_base UNION ALL SELECT * FROM connection_base)
    WHERE risque_depassement""",
)
def breach_risk(t):
    parts = [sla.detail(t.complaints, kind, AS_OF) for kind in ("COUPURE_ELECTRIQUE", "FACTURATION", "RACCORDEMENT_RESEAU")]
    flagged = parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("risque_depassement")
    return flagged.select("id_reclamation", "type_reclamation", "heures_restantes")


@query(
    "p09_sla_breaches",
    """SELECT id_reclamation, client_id, type_reclamation, priorite, statut, region, round(duree_heures, 4) AS duree_heures, sla_heures,
      round(duree_heures - sla_heures, 4) AS depassement_heures
    FROM timed WHERE statut <> 'CLOTURE' AND duree_heures > sla_heures""",
)
def sla_breaches(t):
    rows = sla.with_limit(enrich.with_elapsed(t.tickets, AS_OF))
    return sla.breaches(rows).select(
        "id_reclamation", "client_id", "type_reclamation", "priorite", "statut", "region", "duree_heures",
        "sla_heures", "depassement_heures",
    )


@query(
    "p10_at_risk",
    """SELECT id_reclamation, type_reclamation, round(sla_heures - duree_heures, 4) AS temps_restant_heures
    FROM timed WHERE statut IN ('OUVERT', 'EN_COURS') AND sla_heures - duree_heures <= 24""",
)
def at_risk(t):
    return sla.at_risk(timed(t)).select("id_reclamation", "type_reclamation", "temps_restant_heures")


_TOP = {
    "t02_worst_breaches": (
        "SELECT id_reclamation, round(duree_heures - sla_heures, 4) AS depassement_heures FROM timed "
        "WHERE statut <> 'CLOTURE' AND duree_heures > sla_heures ORDER BY duree_heures - sla_heures DESC, id_reclamation LIMIT 20"
    ),
    "t02_soonest_deadlines": (
        "SELECT id_reclamation, round(sla_heures - duree_heures, 4) AS temps_restant_heures FROM timed "
        "WHERE statut IN ('OUVERT', 'EN_COURS') AND sla_heures - duree_heures BETWEEN 0 AND 400 "
        "ORDER BY sla_heures - duree_heures, id_reclamation LIMIT 20"
    ),
}


@query("t02_worst_breaches", _TOP["t02_worst_breaches"])
def worst_breaches(t):
    return (
        sla.breaches(timed(t))
        .orderBy(F.desc("depassement_heures"), "id_reclamation")
        .limit(20)
        .select("id_reclamation", "depassement_heures")
    )


@query("t02_soonest_deadlines", _TOP["t02_soonest_deadlines"])
def soonest_deadlines(t):
    return (
        sla.at_risk(timed(t), hours=400)
        .filter(F.col("temps_restant_heures") >= 0)
        .orderBy("temps_restant_heures", "id_reclamation")
        .limit(20)
        .select("id_reclamation", "temps_restant_heures")
    )


@query(
    "p11_alert_level",
    """SELECT id_reclamation, CASE WHEN risque_depassement THEN 'RISQUE_IMMINENT' WHEN duree_heures > sla_heures THEN 'HORS_SLA'
      WHEN heures_restantes < sla_heures * 0.2::DOUBLE THEN 'EN_VIGILANCE' ELSE 'NOMINAL' END AS niveau_alerte
    FROM connection_base WHERE statut IN ('OUVERT', 'EN_COURS')""",
)
def alert_level(t):
    rows = sla.detail(t.complaints, "RACCORDEMENT_RESEAU", AS_OF).filter(C.is_open())
    return rows.select("id_reclamation", sla.alert_level().alias("niveau_alerte"))


@query(
    "p12_type_filter",
    "SELECT id_reclamation, client_id, reference_linky FROM tickets WHERE type_reclamation = 'COMPTEUR_LINKY'",
)
def type_filter(t):
    return t.complaints.filter(F.col("type_reclamation") == "COMPTEUR_LINKY").select(
        "id_reclamation", "client_id", "reference_linky"
    )


@query(
    "p36_sla_alert_status",
    """SELECT count(*) FILTER (WHERE statut <> 'CLOTURE' AND duree_heures > sla_heures) AS nb_depassements,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS') AND sla_heures - duree_heures <= 24) AS nb_a_risque,
      CASE WHEN count(*) FILTER (WHERE statut <> 'CLOTURE' AND duree_heures > sla_heures) > 50 THEN 'ALERTE' ELSE 'NORMAL' END AS statut_sla,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS') AND sla_heures - duree_heures <= 24) > 100 AS alerte_risque
    FROM timed""",
)
def sla_alert_status(t):
    return sla.alert_summary(timed(t))


_VOLUMES = """SELECT region, type_reclamation, count(*) AS nombre_reclamations,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS nombre_ouvertes,
      count(*) FILTER (WHERE statut = 'CLOTURE') AS nombre_cloturees FROM timed GROUP BY 1, 2"""
_DELAYS = """SELECT region, type_reclamation, round(avg(duree_traitement_heures), 4) AS duree_moyenne_traitement,
      round(quantile_disc(duree_traitement_heures, 0.5), 4) AS duree_mediane_traitement,
      round(avg(delai_premiere_reponse_heures), 4) AS delai_moyen_premiere_reponse_heures
      FROM timed WHERE duree_traitement_heures IS NOT NULL GROUP BY 1, 2"""
_RATES = """SELECT region, type_reclamation, count(*) AS total_reclamations_traitees,
      count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) AS nb_respect_sla,
      count(*) FILTER (WHERE priorite = 'CRITIQUE') AS nb_critiques, count(*) FILTER (WHERE statut = 'ESCALADE') AS nb_escalades,
      round(100.0::DOUBLE * count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) / count(*), 4) AS taux_respect_sla,
      round(100.0::DOUBLE * count(*) FILTER (WHERE priorite = 'CRITIQUE') / count(*), 4) AS taux_critique,
      round(100.0::DOUBLE * count(*) FILTER (WHERE statut = 'ESCALADE') / count(*), 4) AS taux_escalade
      FROM timed WHERE duree_traitement_heures IS NOT NULL GROUP BY 1, 2"""


@query("a11_kpi_volumes", _VOLUMES)
def kpi_volumes(t):
    return kpi.volumes(t.tickets)


@query("a11b_kpi_delays", _DELAYS)
def kpi_delays(t):
    return kpi.delays(closed_durations(t))


@query("a11c_kpi_sla", _RATES)
def kpi_sla(t):
    return kpi.sla_rates(closed_durations(t))


_MERGED = f"""WITH v AS ({_VOLUMES}), d AS ({_DELAYS}), s AS ({_RATES})
    SELECT region, type_reclamation, nombre_reclamations, nombre_ouvertes, nombre_cloturees, duree_moyenne_traitement,
      duree_mediane_traitement, delai_moyen_premiere_reponse_heures, taux_respect_sla, nb_critiques, taux_critique, taux_escalade
    FROM v FULL JOIN d USING (region, type_reclamation) FULL JOIN s USING (region, type_reclamation)"""


@query("j05_kpi_merge", _MERGED)
def kpi_merge(t):
    df = closed_durations(t)
    return kpi.merged(kpi.volumes(df), kpi.delays(df), kpi.sla_rates(df))


@query("j05_kpi_single_scan", _MERGED)
def kpi_single_scan(t):
    return kpi.indicators(closed_durations(t))


@query(
    "a12_sla_compliance",
    """SELECT region, type_reclamation, count(*) AS total_reclamations,
      count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) AS nb_conformes,
      count(*) FILTER (WHERE duree_traitement_heures > sla_heures) AS nb_non_conformes,
      round(100.0::DOUBLE * count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) / count(*), 4) AS taux_conformite,
      '2001-08-02' AS date_calcul
    FROM timed WHERE duree_traitement_heures IS NOT NULL GROUP BY 1, 2""",
)
def sla_compliance(t):
    return sla.compliance(closed_durations(t), AS_OF)


@query(
    "j06_billing_invoices",
    """SELECT id_reclamation, reference_linky, round(montant_conteste, 4) AS montant_conteste, type_erreur_facturation, sla_respect,
      risque_depassement, round(heures_restantes, 4) AS heures_restantes FROM billing_detail""",
)
def billing_invoices(t):
    return sla.billing_detail(t.complaints, t.invoices, AS_OF).select(
        "id_reclamation", "reference_linky", "montant_conteste",
        "type_erreur_facturation", "sla_respect", "risque_depassement", "heures_restantes",
    )


@query(
    "s09_optional_invoices",
    """SELECT id_reclamation, CAST(NULL AS DOUBLE) AS montant_conteste, CAST(NULL AS VARCHAR) AS type_erreur_facturation FROM billing_base""",
)
def optional_invoices(t):
    from gridvoice.sources.readers import optional_parquet

    missing = optional_parquet(t.spark, f"{t.directory}/absent_invoices.parquet")
    return sla.billing_detail(t.complaints, missing, AS_OF).select(
        "id_reclamation", "montant_conteste", "type_erreur_facturation"
    )


@query(
    "j07_connection_work",
    """SELECT id_reclamation, technicien_id, zone_intervention, date_intervention_prevue::VARCHAR AS date_intervention_prevue,
      intervention_planifiee FROM connection_detail""",
)
def connection_work(t):
    return sla.connection_detail(t.complaints, t.interventions, AS_OF).select(
        "id_reclamation", "technicien_id", "zone_intervention", "date_intervention_prevue", "intervention_planifiee"
    )


@query(
    "a30_billing_metrics",
    """SELECT count(*) AS total, round((sum(montant_conteste))::DECIMAL(28,8), 2)::DOUBLE AS montant_total, round((avg(montant_conteste))::DECIMAL(28,8), 2)::DOUBLE AS montant_moyen,
      count(*) FILTER (WHERE NOT sla_respect AND date_cloture IS NOT NULL) AS hors_sla,
      count(*) FILTER (WHERE risque_depassement) AS en_risque FROM billing_detail""",
    digits=2,
)
def billing_metrics(t):
    return sla.billing_metrics(sla.billing_detail(t.complaints, t.invoices, AS_OF))


@query(
    "a31_planning_report",
    """SELECT region, count(*) AS total, count(*) FILTER (WHERE intervention_planifiee) AS avec_planification,
      count(*) FILTER (WHERE NOT intervention_planifiee) AS sans_planification,
      count(*) FILTER (WHERE risque_depassement) AS en_risque_sla, round((avg(duree_heures))::DECIMAL(28,8), 1)::DOUBLE AS duree_moyenne_h
    FROM connection_detail GROUP BY 1""",
)
def planning_report(t):
    return sla.planning_report(sla.connection_detail(t.tickets, t.interventions, AS_OF))


@query(
    "a32_outage_alerts",
    """SELECT count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS') AND duree_heures > sla_heures) AS depassements,
      count(*) FILTER (WHERE risque_depassement) AS risques FROM outage_detail""",
)
def outage_alerts(t):
    return sla.outage_alerts(sla.detail(t.complaints, "COUPURE_ELECTRIQUE", AS_OF))


@query(
    "t02_worst_compliance",
    """SELECT region, type_reclamation, round(100.0::DOUBLE * count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) / count(*), 4) AS taux_conformite
    FROM timed WHERE duree_traitement_heures IS NOT NULL GROUP BY 1, 2
    ORDER BY count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) / count(*), region, type_reclamation LIMIT 20""",
)
def worst_compliance(t):
    return (
        sla.compliance(closed_durations(t), AS_OF)
        .orderBy("taux_conformite", "region", "type_reclamation")
        .limit(20)
        .select("region", "type_reclamation", "taux_conformite")
    )
