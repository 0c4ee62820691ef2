"""Consolidated table, weekly and monthly figures, reporting views."""

from pyspark.sql import functions as F

from gridvoice.operators import consolidate, enrich, kpi, sketches, sla
from gridvoice.plans.registry import query
from gridvoice.sources.conform import AS_OF, register_sql_view

RUN = "2001-08-02"

register_sql_view(
    "details",
    """SELECT id_reclamation, sla_respect, risque_depassement, heures_restantes, 'coupures' AS source FROM outage_detail
      UNION ALL SELECT id_reclamation, sla_respect, risque_depassement, heures_restantes, 'facturation' FROM billing_base
      UNION ALL SELECT id_reclamation, sla_respect, risque_depassement, heures_restantes, 'raccordement' FROM connection_base""",
)
register_sql_view(
    "consolidated",
    """SELECT t.id_reclamation, t.client_id, t.region, t.departement, t.type_reclamation, t.statut, t.priorite, t.date_creation,
        t.date_cloture, t.duree_traitement_heures AS duree_heures, t.sla_heures,
        CASE WHEN d.id_reclamation IS NOT NULL THEN d.sla_respect
          ELSE CASE WHEN t.date_cloture IS NOT NULL THEN t.duree_traitement_heures <= t.sla_heures END END AS sla_respect,
        CASE WHEN d.id_reclamation IS NOT NULL THEN d.risque_depassement ELSE FALSE END AS risque_depassement,
        d.heures_restantes, coalesce(d.source, 'base') AS source, DATE '2001-08-02' AS export_date
      FROM timed t LEFT JOIN details d ON t.id_reclamation = d.id_reclamation""",
)
register_sql_view(
    "kpi_history",
    """SELECT CAST(date_creation AS DATE) AS date_calcul, region, type_reclamation, count(*) AS nombre_reclamations_total,
        count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS nombre_ouvertes,
        count(*) FILTER (WHERE statut = 'CLOTURE') AS nombre_cloturees, avg(duree_traitement_heures) AS duree_moyenne_traitement,
        quantile_disc(duree_traitement_heures, 0.5) AS duree_mediane_traitement,
        100.0::DOUBLE * count(*) FILTER (WHERE duree_traitement_heures <= sla_heures) / nullif(count(duree_traitement_heures), 0) AS taux_respect_sla,
        count(*) FILTER (WHERE priorite = 'CRITIQUE') AS nb_critiques,
        100.0::DOUBLE * count(*) FILTER (WHERE statut = 'ESCALADE') / count(*) AS taux_escalade
      FROM timed GROUP BY 1, 2, 3""",
)


def consolidated(t):
    tickets = enrich.with_durations(t.tickets)
    sources = {"COUPURE_ELECTRIQUE": "coupures", "FACTURATION": "facturation", "RACCORDEMENT_RESEAU": "raccordement"}
    return consolidate.consolidate(tickets, sla.details(t.complaints, sources, AS_OF), RUN)


def kpi_history(t):
    return kpi.daily_history(enrich.with_durations(t.tickets))


@query(
    "a21_consolidated",
    """SELECT id_reclamation, type_reclamation, statut, round(duree_heures, 4) AS duree_heures, sla_heures, sla_respect, risque_depassement,
      round(heures_restantes, 4) AS heures_restantes, source, export_date::VARCHAR AS export_date FROM consolidated""",
)
def consolidated_table(t):
    return consolidated(t).select(
        "id_reclamation", "type_reclamation", "statut", "duree_heures", "sla_heures", "sla_respect",
        "risque_depassement", "heures_restantes", "source", "export_date",
    )


@query(
    "j11_join_update",
    """SELECT source, sla_respect, count(*) AS nb, count(heures_restantes) AS nb_restantes FROM consolidated GROUP BY 1, 2""",
)
def join_update(t):
    return consolidated(t).groupBy("source", "sla_respect").agg(
        F.count(F.lit(1)).alias("nb"), F.count("heures_restantes").alias("nb_restantes")
    )


@query(
    "a22_cross_type_kpis",
    """SELECT region, type_reclamation, count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS nombre_ouvertes,
      count(*) FILTER (WHERE statut = 'CLOTURE') AS nombre_cloturees, round((avg(duree_heures))::DECIMAL(28,8), 2)::DOUBLE AS duree_moyenne_traitement,
      round((100.0::DOUBLE * count(*) FILTER (WHERE sla_respect) / nullif(count(sla_respect), 0))::DECIMAL(28,8), 2)::DOUBLE AS taux_respect_sla,
      count(*) FILTER (WHERE priorite = 'CRITIQUE') AS nb_critiques,
      round((100.0::DOUBLE * count(*) FILTER (WHERE priorite = 'CRITIQUE') / count(*))::DECIMAL(28,8), 2)::DOUBLE AS taux_critique, '2001-08-02' AS date_calcul
    FROM consolidated GROUP BY 1, 2""",
)
def cross_type_kpis(t):
    return consolidate.cross_type_kpis(consolidated(t), RUN)


@query(
    "a23_consolidation_summary",
    """SELECT type_reclamation, count(*) AS total, count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS en_cours,
      count(*) FILTER (WHERE NOT sla_respect AND date_cloture IS NOT NULL) AS hors_sla,
      count(*) FILTER (WHERE risque_depassement) AS en_risque, round((avg(duree_heures))::DECIMAL(28,8), 1)::DOUBLE AS duree_moy_h
    FROM consolidated GROUP BY 1""",
)
def consolidation_summary(t):
    return consolidate.summary(consolidated(t), RUN)


@query(
    "t05_latest_export_active",
    """SELECT id_reclamation, CASE WHEN risque_depassement THEN 'RISQUE_IMMINENT' WHEN duree_heures > sla_heures THEN 'HORS_SLA'
      WHEN heures_restantes < sla_heures * 0.2::DOUBLE THEN 'EN_VIGILANCE' ELSE 'NOMINAL' END AS niveau_alerte
    FROM consolidated WHERE statut IN ('OUVERT', 'EN_COURS') AND export_date = (SELECT max(export_date) FROM consolidated)""",
)
def latest_export_active(t):
    return consolidate.active_complaints(consolidated(t)).select(
        "id_reclamation", sla.alert_level().alias("niveau_alerte")
    )


_FIGURES = """sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS total_reclamations, sum(nombre_ouvertes)::BIGINT AS total_ouvertes,
  sum(nombre_cloturees)::BIGINT AS total_cloturees, round((avg(duree_moyenne_traitement))::DECIMAL(28,8), 2)::DOUBLE AS duree_moyenne_heures,
  round((avg(duree_mediane_traitement))::DECIMAL(28,8), 2)::DOUBLE AS duree_mediane_heures, round((avg(taux_respect_sla))::DECIMAL(28,8), 2)::DOUBLE AS taux_respect_sla,
  round((avg(nb_critiques))::DECIMAL(28,8), 2)::DOUBLE AS taux_critique"""


def _weekly(day: str) -> str:
    return f"""SELECT extract(isoyear FROM DATE '{day}' - 7)::INTEGER AS annee, extract(week FROM DATE '{day}' - 7)::INTEGER AS semaine,
      (DATE '{day}' - 7)::VARCHAR AS debut_semaine, (DATE '{day}' - 1)::VARCHAR AS fin_semaine, c.*,
      round((CASE WHEN prec > 0 THEN 100.0::DOUBLE * (total_reclamations - prec) / prec END)::DECIMAL(28,8), 2)::DOUBLE AS evolution_vs_semaine_precedente
    FROM (SELECT region, type_reclamation, {_FIGURES},
        round(((1 - avg(nb_critiques::DOUBLE / nullif(nombre_reclamations_total, 0))) * 100)::DECIMAL(28,8), 2)::DOUBLE AS taux_non_critique
      FROM daily_kpi WHERE date_calcul BETWEEN DATE '{day}' - 7 AND DATE '{day}' - 1 GROUP BY 1, 2) c
    LEFT JOIN (SELECT region, type_reclamation, sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS prec FROM daily_kpi
      WHERE date_calcul BETWEEN DATE '{day}' - 14 AND DATE '{day}' - 8 GROUP BY 1, 2) p USING (region, type_reclamation)"""


@query("a17_weekly_rollup", _weekly("2024-01-22"))
def weekly_rollup(t):
    return kpi.weekly(t.kept("daily_kpi"), "2024-01-22")


@query(
    "j10_week_over_week",
    f"""SELECT region, type_reclamation, total_reclamations, evolution_vs_semaine_precedente FROM ({_weekly('2024-01-08')})""",
)
def week_over_week(t):
    return kpi.weekly(t.kept("daily_kpi"), "2024-01-08").select(
        "region", "type_reclamation", "total_reclamations", "evolution_vs_semaine_precedente"
    )


def _from_sketches(unit: str, name: str) -> str:
    return f"""SELECT date_trunc('{unit}', date_creation)::DATE::VARCHAR AS {name}, region, type_reclamation, count(*) AS nombre_reclamations_total,
      count(duree_traitement_heures) AS nb_durees, count(DISTINCT client_id) AS nb_clients_exact, TRUE AS clients_juste, TRUE AS mediane_juste
    FROM timed GROUP BY 1, 2, 3"""


def daily_sketches(t):
    return t.kept("daily_sketches", lambda: sketches.daily(enrich.with_durations(t.tickets)))


@query("a17_weekly_sketches", _from_sketches("week", "debut_semaine"))
def weekly_sketches(t):
    """Distinct clients and medians of every week from stored daily sketches, judged against the rows."""
    found = sketches.estimates(sketches.weekly(daily_sketches(t)))
    rows = enrich.with_durations(t.tickets)
    return sketches.against_rows(found, rows, F.trunc("date_creation", "week"), "debut_semaine")


@query("a19_monthly_sketches", _from_sketches("month", "debut_mois"))
def monthly_sketches(t):
    found = sketches.estimates(sketches.monthly(daily_sketches(t)))
    rows = enrich.with_durations(t.tickets)
    return sketches.against_rows(found, rows, F.trunc("date_creation", "month"), "debut_mois")


@query(
    "a18_weekly_summary",
    f"""WITH s AS ({_weekly('2024-01-15')} UNION ALL {_weekly('2024-01-22')})
    SELECT type_reclamation, sum(total_reclamations)::BIGINT AS total, round(((sum(taux_respect_sla::DECIMAL(20,6))::DOUBLE / count(taux_respect_sla)))::DECIMAL(28,8), 1)::DOUBLE AS taux_sla_moy,
      round(((sum(evolution_vs_semaine_precedente::DECIMAL(20,6))::DOUBLE / count(evolution_vs_semaine_precedente)))::DECIMAL(28,8), 1)::DOUBLE AS evolution
    FROM s WHERE debut_semaine = (SELECT max(debut_semaine) FROM s) GROUP BY 1""",
)
def weekly_summary(t):
    daily = t.kept("daily_kpi")
    weeks = kpi.weekly(daily, "2024-01-15").unionByName(kpi.weekly(daily, "2024-01-22"))
    return kpi.weekly_summary(weeks)


_MONTHLY = f"""SELECT 2000 AS annee, 7 AS mois, c.*,
      round((CASE WHEN m1 > 0 THEN 100.0::DOUBLE * (total_reclamations - m1) / m1 END)::DECIMAL(28,8), 2)::DOUBLE AS evolution_vs_mois_precedent,
      round((CASE WHEN an > 0 THEN 100.0::DOUBLE * (total_reclamations - an) / an END)::DECIMAL(28,8), 2)::DOUBLE AS evolution_vs_meme_mois_an_dernier,
      CASE type_reclamation WHEN 'COUPURE_ELECTRIQUE' THEN 48 WHEN 'COMPTEUR_LINKY' THEN 120 WHEN 'FACTURATION' THEN 240
        WHEN 'RACCORDEMENT_RESEAU' THEN 360 WHEN 'INTERVENTION_TECHNIQUE' THEN 168 END AS sla_cible
    FROM (SELECT region, type_reclamation, {_FIGURES}, round((avg(taux_escalade))::DECIMAL(28,8), 2)::DOUBLE AS taux_escalade FROM kpi_history
      WHERE date_calcul BETWEEN DATE '2000-07-01' AND DATE '2000-07-31' GROUP BY 1, 2) c
    LEFT JOIN (SELECT region, type_reclamation, sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS m1 FROM kpi_history
      WHERE date_calcul BETWEEN DATE '2000-06-01' AND DATE '2000-06-30' GROUP BY 1, 2) m USING (region, type_reclamation)
    LEFT JOIN (SELECT region, type_reclamation, sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS an FROM kpi_history
      WHERE date_calcul BETWEEN DATE '1999-07-01' AND DATE '1999-07-31' GROUP BY 1, 2) a USING (region, type_reclamation)"""


@query("a19_monthly_rollup", _MONTHLY)
def monthly_rollup(t):
    return kpi.monthly(t.kept("kpi_history", lambda: kpi_history(t)), "2000-08-01")


@query(
    "a20_monthly_sla_report",
    f"""SELECT type_reclamation, sla_cible, sum(total_reclamations)::BIGINT AS total, round(((sum(taux_respect_sla::DECIMAL(20,6))::DOUBLE / count(taux_respect_sla)))::DECIMAL(28,8), 1)::DOUBLE AS taux_sla_moy,
      min(taux_respect_sla) AS taux_sla_min, round(((sum(evolution_vs_mois_precedent::DECIMAL(20,6))::DOUBLE / count(evolution_vs_mois_precedent)))::DECIMAL(28,8), 1)::DOUBLE AS evol_m1
    FROM ({_MONTHLY}) GROUP BY 1, 2""",
)
def monthly_sla_report(t):
    months = kpi.monthly(t.kept("kpi_history", lambda: kpi_history(t)), "2000-08-01")
    return kpi.monthly_sla_report(months, "2000-07")


@query(
    "a46_sla_summary",
    """SELECT region, type_reclamation, sum(nombre_reclamations_total)::BIGINT AS total_reclamations, sum(nombre_ouvertes)::BIGINT AS en_cours,
      round((avg(taux_respect_sla))::DECIMAL(28,8), 2)::DOUBLE AS taux_sla_moyen, round((avg(duree_moyenne_traitement))::DECIMAL(28,8), 2)::DOUBLE AS duree_moyenne_h,
      max(date_calcul)::VARCHAR AS derniere_date
    FROM kpi_history WHERE date_calcul >= DATE '2001-08-02' - 30 GROUP BY 1, 2""",
)
def sla_summary(t):
    return kpi.sla_summary(kpi_history(t), RUN)


@query(
    "a47_top_meter_faults",
    """SELECT region, type_panne, count(*) AS occurrences, round((avg(duree_heures))::DECIMAL(28,8), 1)::DOUBLE AS duree_moyenne_h,
      max(export_date)::VARCHAR AS derniere_observation
    FROM linky_detail WHERE export_date >= DATE '2024-01-31' - 30 GROUP BY 1, 2""",
)
def top_meter_faults(t):
    return kpi.top_meter_faults(t.linky_detail, "2024-01-31")


@query(
    "a48_sla_by_region",
    """SELECT date_calcul::VARCHAR AS date_calcul, region, type_reclamation, round((avg(taux_respect_sla))::DECIMAL(28,8), 2)::DOUBLE AS taux_sla_moyen,
      sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS volume_total, round((avg(duree_moyenne_traitement))::DECIMAL(28,8), 2)::DOUBLE AS duree_moy
    FROM kpi_history WHERE date_calcul >= DATE '2001-08-02' - 365 GROUP BY 1, 2, 3""",
)
def sla_by_region(t):
    return kpi.sla_by_region(kpi_history(t), RUN)


@query(
    "w03_moving_average",
    """SELECT date_calcul::VARCHAR AS date_calcul, type_reclamation, sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS volume_total,
      round((avg(taux_respect_sla))::DECIMAL(28,8), 2)::DOUBLE AS taux_sla, round((avg(duree_moyenne_traitement))::DECIMAL(28,8), 2)::DOUBLE AS duree_moy,
      round((avg(avg(taux_respect_sla)) OVER (PARTITION BY type_reclamation ORDER BY daily_kpi.date_calcul ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))::DECIMAL(28,8), 2)::DOUBLE AS taux_sla_mm7j
    FROM daily_kpi WHERE daily_kpi.date_calcul >= DATE '2024-01-31' - 90 GROUP BY daily_kpi.date_calcul, type_reclamation""",
)
def moving_average(t):
    return kpi.trends(t.daily_kpi, "2024-01-31")


@query(
    "a51_scenario_summary",
    """SELECT CASE WHEN id_reclamation % 20 < 14 THEN 'NORMAL' WHEN id_reclamation % 20 < 17 THEN 'HORS_SLA'
        WHEN id_reclamation % 20 < 19 THEN 'RISQUE_SLA' ELSE 'CRITIQUE_COUPURE' END AS scenario_test, count(*) AS nb,
      count(*) FILTER (WHERE statut = 'CLOTURE') AS cloturees, round((avg(duree_traitement_heures))::DECIMAL(28,8), 1)::DOUBLE AS duree_moy
    FROM timed GROUP BY 1""",
)
def scenario_summary(t):
    k = F.col("id_reclamation") % 20
    label = (
        F.when(k < 14, "NORMAL").when(k < 17, "HORS_SLA").when(k < 19, "RISQUE_SLA").otherwise("CRITIQUE_COUPURE")
    )
    return kpi.scenario_summary(enrich.with_durations(t.complaints).withColumn("scenario_test", label))


@query(
    "a53_daily_kpis_with_recurrence",
    """WITH r AS (SELECT *, count(*) OVER (PARTITION BY client_id, type_reclamation) >= 2 AS rec,
        CASE WHEN date_cloture IS NOT NULL THEN duree_traitement_heures <= sla_heures END AS ok FROM timed)
    SELECT CAST(date_creation AS DATE)::VARCHAR AS jour, region, type_reclamation, count(*) AS nb_reclamations_total,
      count(*) FILTER (WHERE statut = 'OUVERT') AS nb_reclamations_ouvertes, count(*) FILTER (WHERE statut = 'CLOTURE') AS nb_reclamations_closes,
      round(avg(duree_traitement_heures), 4) AS duree_moyenne_traitement_heures,
      round(100.0::DOUBLE * count(*) FILTER (WHERE ok) / count(*), 4) AS taux_respect_sla,
      count(*) FILTER (WHERE NOT ok) AS nb_depassements_sla,
      round(100.0::DOUBLE * count(*) FILTER (WHERE rec) / count(*), 4) AS taux_recurrence
    FROM r GROUP BY 1, 2, 3""",
)
def daily_kpis_with_recurrence(t):
    df = enrich.with_recurrence(sla.with_limit(enrich.with_elapsed(enrich.with_durations(t.tickets), AS_OF)))
    df = sla.with_compliance(df).withColumnRenamed("sla_respect", "sla_respecte")
    return kpi.complaint_daily(df)


@query(
    "a54_region_statistics",
    """SELECT region, count(*) AS total_reclamations, count(DISTINCT client_id) AS nb_clients,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS en_cours, count(*) FILTER (WHERE statut = 'CLOTURE') AS cloturees,
      round(avg(duree_traitement_heures), 4) AS duree_moyenne_heures
    FROM timed GROUP BY 1""",
)
def region_statistics(t):
    return kpi.region_statistics(enrich.with_durations(t.tickets))


@query(
    "a54_top_clients",
    """SELECT client_id, count(*) AS nb_reclamations, max(date_creation)::VARCHAR AS derniere_reclamation
    FROM tickets GROUP BY 1 ORDER BY nb_reclamations DESC, client_id LIMIT 100""",
)
def top_clients(t):
    return kpi.top_clients(t.complaints)


@query(
    "t06_mixed_order",
    """SELECT date_calcul::VARCHAR AS date_calcul, region, type_reclamation, nombre_ouvertes FROM daily_kpi
    ORDER BY daily_kpi.date_calcul DESC, region, type_reclamation""",
)
def mixed_order(t):
    ordered = t.daily_kpi.orderBy(F.desc("date_calcul"), "region", "type_reclamation")
    return ordered.select("date_calcul", "region", "type_reclamation", "nombre_ouvertes")
