"""Durations, scores, recurrence and labels on complaints."""

from pyspark.sql import functions as F

from gridvoice.operators import enrich, kpi, sla
from gridvoice.plans.registry import query
from gridvoice.sources.conform import AS_OF

_HOURS = """
  date_diff('second', date_creation, date_cloture) / 3600.0::DOUBLE AS duree_traitement_heures,
  date_diff('second', date_creation, date_premiere_reponse) / 3600.0::DOUBLE AS delai_premiere_reponse_heures"""

_SCORE = """CASE priorite WHEN 'CRITIQUE' THEN 100 WHEN 'HAUTE' THEN 75 WHEN 'NORMALE' THEN 50 WHEN 'BASSE' THEN 25 ELSE 50 END
  + CASE WHEN statut IN ('OUVERT', 'EN_COURS') THEN 20 ELSE 0 END
  - CASE WHEN delai_premiere_reponse_heures > 24 THEN 10 ELSE 0 END"""

_DAY_HOURS = f"""
  date_diff('day', date_creation, coalesce(date_cloture, TIMESTAMP '{AS_OF}')) * 24 AS duree_traitement_heures,
  date_diff('day', date_creation, date_premiere_reponse) * 24 AS delai_premiere_reponse_heures"""

_ENRICHED = f"""
  WITH d AS (SELECT *, {_DAY_HOURS} FROM tickets),
  enriched AS (SELECT *, {_SCORE} AS score_priorite,
      count(*) OVER (PARTITION BY client_id, type_reclamation) AS nombre_reclamations_client,
      count(*) OVER (PARTITION BY client_id, type_reclamation) >= 2 AS est_recurrent FROM d)"""


@query(
    "p02_exact_durations",
    f"""SELECT id_reclamation, round(duree_traitement_heures, 4) AS duree_traitement_heures,
      round(delai_premiere_reponse_heures, 4) AS delai_premiere_reponse_heures
    FROM (SELECT *, {_HOURS} FROM tickets)""",
)
def exact_durations(t):
    return enrich.with_durations(t.complaints).select(
        "id_reclamation", "duree_traitement_heures", "delai_premiere_reponse_heures"
    )


@query(
    "p03_elapsed_duration",
    f"""SELECT id_reclamation, round(date_diff('second', date_creation, coalesce(date_cloture, TIMESTAMP '{AS_OF}')) / 3600.0::DOUBLE, 4) AS duree_heures
    FROM tickets""",
)
def elapsed_duration(t):
    return enrich.with_elapsed(t.complaints, AS_OF).select("id_reclamation", "duree_heures")


@query("p04_day_durations", f"SELECT id_reclamation, {_DAY_HOURS} FROM tickets")
def day_durations(t):
    return enrich.with_day_durations(t.complaints, AS_OF).select(
        "id_reclamation", "duree_traitement_heures", "delai_premiere_reponse_heures"
    )


@query(
    "p01_priority_score",
    f"""SELECT id_reclamation, priorite, statut, {_SCORE} AS score_priorite
    FROM (SELECT *, {_HOURS} FROM tickets)""",
)
def priority_score(t):
    return enrich.with_priority_score(enrich.with_durations(t.complaints)).select(
        "id_reclamation", "priorite", "statut", "score_priorite"
    )


@query(
    "w01_recurrence",
    """SELECT id_reclamation, count(*) OVER w AS nombre_reclamations_client, count(*) OVER w >= 2 AS est_recurrent
    FROM tickets WINDOW w AS (PARTITION BY client_id, type_reclamation)""",
)
def recurrence(t):
    return enrich.with_recurrence(t.complaints).select("id_reclamation", "nombre_reclamations_client", "est_recurrent")


def gold_enriched(t):
    """Day durations, score and recurrence: the enriched layer feeding the daily KPIs."""
    days = enrich.with_day_durations(t.tickets, AS_OF)
    return enrich.with_recurrence(enrich.with_priority_score(days))


@query(
    "a09_gold_daily_kpis",
    f"""{_ENRICHED}
    SELECT region, type_reclamation, count(*) AS nombre_reclamations_total,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS nombre_ouvertes,
      count(*) FILTER (WHERE statut = 'CLOTURE') AS nombre_cloturees,
      round(avg(duree_traitement_heures), 4) AS duree_moyenne_traitement,
      quantile_disc(duree_traitement_heures, 0.5) AS duree_mediane_traitement,
      round(avg(delai_premiere_reponse_heures), 4) AS delai_moyen_premiere_reponse,
      count(*) FILTER (WHERE priorite = 'CRITIQUE') AS nb_critiques,
      count(*) FILTER (WHERE est_recurrent) AS nb_recurrentes, '2001-08-02' AS date_calcul
    FROM enriched GROUP BY region, type_reclamation""",
)
def gold_daily_kpis(t):
    return kpi.gold_daily(gold_enriched(t), AS_OF)


@query(
    "a10_region_analytics",
    f"""{_ENRICHED}
    SELECT region, count(*) AS total_reclamations, round(avg(score_priorite), 4) AS score_priorite_moyen,
      round(avg(duree_traitement_heures), 4) AS duree_moyenne_traitement,
      round(count(*) FILTER (WHERE est_recurrent) * 100.0::DOUBLE / count(*), 4) AS taux_recurrence_pct,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS en_cours,
      count(*) FILTER (WHERE priorite = 'CRITIQUE') AS nb_critiques, '2001-08-02' AS date_snapshot
    FROM enriched GROUP BY region""",
)
def region_analytics(t):
    return kpi.region_analytics(gold_enriched(t), AS_OF)


@query(
    "w07_zone_day_volume",
    """SELECT id_reclamation, region, count(*) OVER (PARTITION BY region, CAST(date_creation AS DATE)) AS nb_reclamations_zone_jour
    FROM tickets""",
)
def zone_day_volume(t):
    df = t.tickets.withColumn("jour", F.to_date("date_creation"))
    return enrich.with_group_volume(df, ["region", "jour"], "nb_reclamations_zone_jour").select(
        "id_reclamation", "region", "nb_reclamations_zone_jour"
    )


@query(
    "w06_client_sequence",
    """SELECT id_reclamation, client_id, row_number() OVER (PARTITION BY client_id ORDER BY date_creation, id_reclamation) AS num_reclamation_client
    FROM tickets""",
)
def client_sequence(t):
    return enrich.with_sequence_number(
        t.complaints, "client_id", "date_creation", "id_reclamation", "num_reclamation_client"
    ).select("id_reclamation", "client_id", "num_reclamation_client")


@query(
    "p34_partition_columns",
    """SELECT region, year(date_creation)::INTEGER AS annee, month(date_creation)::INTEGER AS mois, count(*) AS nb
    FROM tickets GROUP BY 1, 2, 3""",
)
def partition_columns(t):
    return (
        enrich.with_partition_columns(t.tickets)
        .groupBy("region", "annee", "mois")
        .agg(F.count(F.lit(1)).alias("nb"))
    )


@query(
    "p32_planned_flag",
    """WITH plan AS (SELECT id_reclamation, min(technicien_id) AS technicien_id, min(date_planifiee) AS date_intervention_prevue
      FROM interventions WHERE statut = 'PLANIFIEE' GROUP BY 1)
    SELECT t.id_reclamation, technicien_id IS NOT NULL AND date_intervention_prevue IS NOT NULL AS intervention_planifiee
    FROM tickets t LEFT JOIN plan p ON t.id_reclamation = p.id_reclamation
    WHERE type_reclamation = 'RACCORDEMENT_RESEAU'""",
)
def planned_flag(t):
    return sla.connection_detail(t.complaints, t.interventions, AS_OF).select(
        "id_reclamation", "intervention_planifiee"
    )


@query(
    "p33_meter_age",
    """SELECT id_reclamation, date_diff('day', date_installation::TIMESTAMP, date_creation) AS anciennete_compteur_jours
    FROM tickets t LEFT JOIN meters m ON t.reference_linky = m.reference_linky""",
)
def meter_age(t):
    meters = t.meters.select("reference_linky", "date_installation")
    return enrich.with_meter_age(t.complaints.join(meters, "reference_linky", "left")).select(
        "id_reclamation", "anciennete_compteur_jours"
    )


@query(
    "p38_normalised_reference",
    """SELECT id_reclamation, 'LINKY_' || lpad(regexp_extract(reference_linky, '[0-9]+', 0), greatest(5, length(regexp_extract(reference_linky, '[0-9]+', 0)))::INTEGER, '0') AS reference_normalisee
    FROM (SELECT id_reclamation, 'R-' || client_id AS reference_linky FROM tickets)""",
)
def normalised_reference(t):
    raw = F.concat(F.lit("R-"), F.col("client_id").cast("string"))
    return t.complaints.select(
        "id_reclamation", enrich.normalise_meter_reference(raw).alias("reference_normalisee")
    )


@query(
    "p45_reference_repair",
    """SELECT id_reclamation, CASE WHEN regexp_full_match(reference_linky, 'LKY[0-9]{8}') THEN reference_linky
      ELSE regexp_replace(reference_linky, '[^0-9]', '', 'g') END AS reference_reparee
    FROM tickets""",
)
def reference_repair(t):
    return t.complaints.select(
        "id_reclamation",
        enrich.repair_meter_reference("reference_linky", "^LKY[0-9]{8}$").alias("reference_reparee"),
    )


@query(
    "p39_postcode_zone",
    """SELECT CASE WHEN code_postal LIKE '75%' THEN 'PARIS_CENTRE' WHEN code_postal BETWEEN '78000' AND '78999' THEN 'YVELINES'
      WHEN code_postal BETWEEN '92000' AND '92999' THEN 'HAUTS_DE_SEINE' ELSE 'AUTRE' END AS zone_geographique, count(*) AS nb
    FROM tickets GROUP BY 1""",
)
def postcode_zones(t):
    return t.complaints.groupBy(enrich.postcode_zone().alias("zone_geographique")).agg(F.count(F.lit(1)).alias("nb"))


@query(
    "p40_text_category",
    """SELECT doc_id, CASE WHEN contains(lower(text), 'linky') OR contains(lower(text), 'compteur') THEN 'COMPTEUR_LINKY'
      WHEN contains(lower(text), 'coupure') OR contains(lower(text), 'panne') THEN 'COUPURE_ELECTRIQUE'
      WHEN contains(lower(text), 'facture') OR contains(lower(text), 'montant') THEN 'FACTURATION'
      WHEN contains(lower(text), 'raccordement') OR contains(lower(text), 'travaux') THEN 'RACCORDEMENT' ELSE lang END AS categorie_auto
    FROM documents""",
)
def text_category(t):
    return t.raw("documents").select("doc_id", enrich.text_category("text", "lang").alias("categorie_auto"))


@query(
    "p40_text_category_custom_rules",
    """SELECT CASE WHEN contains(lower(text), ' und ') OR contains(lower(text), ' der ') THEN 'ALLEMAND'
      WHEN contains(lower(text), ' les ') OR contains(lower(text), ' pour ') THEN 'FRANCAIS' ELSE lang END AS categorie_auto,
      count(*) AS nb FROM documents GROUP BY 1""",
)
def text_category_custom(t):
    rules = [("ALLEMAND", [" und ", " der "]), ("FRANCAIS", [" les ", " pour "])]
    return (
        t.raw("documents")
        .groupBy(enrich.text_category("text", "lang", rules).alias("categorie_auto"))
        .agg(F.count(F.lit(1)).alias("nb"))
    )


@query(
    "p41_weighted_priority",
    f"""SELECT id_reclamation, round(
      (CASE priorite WHEN 'CRITIQUE' THEN 100 WHEN 'HAUTE' THEN 75 WHEN 'NORMALE' THEN 50 WHEN 'BASSE' THEN 25 ELSE 50 END) * 0.4::DOUBLE
      + (CASE WHEN count(*) OVER (PARTITION BY client_id, type_reclamation) >= 2 THEN 30 ELSE 0 END) * 0.2::DOUBLE
      + (CASE WHEN latitude IS NOT NULL THEN 40 ELSE 0 END) * 0.2::DOUBLE
      + least(date_diff('day', date_creation, TIMESTAMP '{AS_OF}') * 2, 20) * 0.2::DOUBLE, 4) AS score_pondere
    FROM tickets""",
)
def weighted_priority(t):
    df = enrich.with_recurrence(t.complaints).withColumn("est_lie_incident", F.col("latitude").isNotNull())
    return enrich.weighted_priority(df, AS_OF).select("id_reclamation", "score_pondere")


@query(
    "p42_day_period",
    """SELECT CASE WHEN hour(date_creation) BETWEEN 6 AND 12 THEN 'MATIN' WHEN hour(date_creation) BETWEEN 12 AND 18 THEN 'APRES_MIDI'
      WHEN hour(date_creation) BETWEEN 18 AND 22 THEN 'SOIREE' ELSE 'NUIT' END AS periode_journee,
      dayofweek(date_creation) IN (0, 6) AS est_weekend, count(*) AS nb FROM tickets GROUP BY 1, 2""",
)
def day_periods(t):
    return t.complaints.groupBy(
        enrich.day_period().alias("periode_journee"), enrich.is_weekend().alias("est_weekend")
    ).agg(F.count(F.lit(1)).alias("nb"))


@query(
    "p43_duration_outlier_flag",
    """SELECT id_reclamation, coalesce(date_diff('day', date_creation, date_cloture) > 90, FALSE) AS duree_aberrante FROM tickets""",
)
def duration_outlier_flag(t):
    return t.complaints.select("id_reclamation", enrich.is_duration_outlier().alias("duree_aberrante"))


@query(
    "p44_missing_defaults",
    "SELECT coalesce(canal, 'INCONNU') AS canal, coalesce(priorite, 'MOYENNE') AS priorite, count(*) AS nb FROM tickets GROUP BY 1, 2",
)
def missing_defaults(t):
    return enrich.with_defaults(t.complaints).groupBy("canal", "priorite").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "p46_distance_to_centre",
    """SELECT id_reclamation, round(2 * 6371.0 * asin(sqrt(pow(sin((radians(4.5) - radians(latitude)) / 2), 2)
      + cos(radians(latitude)) * cos(radians(4.5)) * pow(sin((radians(3.5) - radians(longitude)) / 2), 2))), 4) AS distance_centre_km
    FROM tickets""",
)
def distance_to_centre(t):
    return enrich.distance_to_centre(t.complaints, 4.5, 3.5).select("id_reclamation", "distance_centre_km")


@query(
    "p47_first_date_column",
    "SELECT 'date_creation' AS colonne, max(date_creation)::VARCHAR AS derniere FROM tickets",
)
def first_date_column(t):
    name = enrich.first_available(t.complaints, ["created_at", "export_date", "date_creation", "run_date"])
    return t.complaints.agg(F.max(name).alias("derniere")).select(F.lit(name).alias("colonne"), "derniere")
