"""Incident, meter and reading correlations."""

from pyspark.sql import functions as F

from gridvoice.functions.skew import broadcast_if_small
from gridvoice.operators import cleaning, correlation, kpi
from gridvoice.plans.registry import query
from gridvoice.sources.conform import AS_OF, register_sql_view

register_sql_view(
    "linked",
    """SELECT t.*, i.id_incident AS incident_lie,
        sqrt((t.latitude - i.latitude) * (t.latitude - i.latitude) + (t.longitude - i.longitude) * (t.longitude - i.longitude)) * 111.0::DOUBLE AS distance_incident_km
      FROM tickets t LEFT JOIN incidents i ON t.region = i.region AND t.date_creation >= i.date_incident
        AND t.date_creation <= i.date_incident + 3
      QUALIFY row_number() OVER (PARTITION BY t.id_reclamation ORDER BY distance_incident_km ASC NULLS LAST, i.id_incident) = 1""",
)


@query(
    "j01_nearest_incident",
    "SELECT id_reclamation, incident_lie, round(distance_incident_km, 4) AS distance_incident_km FROM linked",
)
def nearest_incident(t):
    return correlation.link_nearest_incident(t.tickets, t.incidents).select(
        "id_reclamation", "incident_lie", "distance_incident_km"
    )


@query(
    "w02_nearest_pick_by_region",
    """SELECT region, count(*) AS nb, count(incident_lie) AS nb_liees, round(avg(distance_incident_km), 4) AS distance_moyenne_km
    FROM linked GROUP BY 1""",
)
def nearest_by_region(t):
    return (
        correlation.link_nearest_incident(t.tickets, t.incidents)
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("nb"),
            F.count("incident_lie").alias("nb_liees"),
            F.avg("distance_incident_km").alias("distance_moyenne_km"),
        )
    )


@query(
    "j03_meter_enrichment",
    """SELECT id_reclamation, type_compteur, puissance_souscrite_kva, date_installation::VARCHAR AS date_installation, est_defectueux,
      nombre_incidents, date_diff('day', date_installation::TIMESTAMP, date_creation) AS anciennete_compteur_jours
    FROM tickets t LEFT JOIN meters m ON t.reference_linky = m.reference_linky WHERE type_reclamation = 'COMPTEUR_LINKY'""",
)
def meter_enrichment(t):
    rows = t.complaints.filter(F.col("type_reclamation") == "COMPTEUR_LINKY")
    return correlation.enrich_with_meters(rows, t.meters).select(
        "id_reclamation", "type_compteur", "puissance_souscrite_kva", "date_installation", "est_defectueux",
        "nombre_incidents", "anciennete_compteur_jours",
    )


register_sql_view(
    "looked_back",
    """SELECT t.id_reclamation, t.region, t.reference_linky, count(r.reference_linky) AS nb_anomalies_releves_6mois,
        avg(r.consommation_kwh) AS conso_moyenne_6mois
      FROM tickets t LEFT JOIN readings r ON t.reference_linky = r.reference_linky AND r.anomalie_detectee
        AND r.date_releve <= t.date_creation AND date_diff('day', r.date_releve::TIMESTAMP, t.date_creation) <= 180
      WHERE t.type_reclamation = 'COMPTEUR_LINKY' GROUP BY 1, 2, 3""",
)


@query(
    "j04_readings_before_complaint",
    "SELECT id_reclamation, nb_anomalies_releves_6mois, round(conso_moyenne_6mois, 4) AS conso_moyenne_6mois FROM looked_back",
)
def readings_before(t):
    rows = t.complaints.filter(F.col("type_reclamation") == "COMPTEUR_LINKY")
    return correlation.abnormal_readings_before(rows, t.readings).select(
        "id_reclamation", "nb_anomalies_releves_6mois", "conso_moyenne_6mois"
    )


@query(
    "a33_linky_kpis",
    """SELECT l.region, count(*) AS nb_reclamations_linky,
      count(*) FILTER (WHERE NOT regexp_full_match(l.reference_linky, 'LKY[0-9]{8}')) AS nb_references_invalides,
      count(*) FILTER (WHERE est_defectueux) AS nb_compteurs_defectueux,
      round(100.0::DOUBLE * count(*) FILTER (WHERE est_defectueux) / count(*), 4) AS taux_compteurs_defectueux,
      round(avg(nb_anomalies_releves_6mois), 4) AS moyenne_anomalies_par_compteur
    FROM looked_back l LEFT JOIN meters m ON l.reference_linky = m.reference_linky GROUP BY 1""",
)
def linky_kpis(t):
    rows = t.tickets.filter(F.col("type_reclamation") == "COMPTEUR_LINKY")
    rows = correlation.abnormal_readings_before(correlation.enrich_with_meters(rows, t.meters), t.readings)
    return correlation.linky_kpis(rows.withColumn("reference_valide", cleaning.is_valid_reference()))


@query(
    "j22_incident_zone",
    f"""SELECT id_reclamation, EXISTS (SELECT 1 FROM incidents i WHERE t.latitude BETWEEN i.latitude - 0.1::DOUBLE AND i.latitude + 0.1::DOUBLE
        AND t.longitude BETWEEN i.longitude - 0.1::DOUBLE AND i.longitude + 0.1::DOUBLE
        AND t.date_creation BETWEEN i.date_incident AND coalesce(i.date_fin::TIMESTAMP, TIMESTAMP '{AS_OF}')) AS est_lie_incident
    FROM tickets t""",
)
def incident_zone(t):
    return correlation.in_incident_zone(t.complaints, t.incidents, AS_OF).select("id_reclamation", "est_lie_incident")


@query(
    "j23_client_history",
    """SELECT id_reclamation, client_id, c_mktsegment AS segment, round(c_acctbal, 4) AS solde
    FROM tickets LEFT JOIN customer ON client_id = c_custkey""",
)
def client_history(t):
    clients = t.raw("customer").select(
        F.col("c_custkey").alias("client_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("solde")
    )
    return correlation.with_client_history(t.complaints, clients).select("id_reclamation", "client_id", "segment", "solde")


@query(
    "j24_checked_broadcast",
    """SELECT type_compteur, est_defectueux, count(*) AS nb FROM tickets t JOIN meters m ON t.reference_linky = m.reference_linky
    GROUP BY 1, 2""",
)
def checked_broadcast(t):
    meters = broadcast_if_small(t.meters.select("reference_linky", "type_compteur", "est_defectueux"))
    return (
        t.complaints.join(meters, "reference_linky")
        .groupBy("type_compteur", "est_defectueux")
        .agg(F.count(F.lit(1)).alias("nb"))
    )


@query(
    "a54_problem_meters",
    """SELECT t.reference_linky, count(*) AS nb_reclamations, max(est_defectueux::INTEGER) AS est_defectueux, max(nombre_incidents) AS nombre_incidents
    FROM tickets t JOIN meters m ON t.reference_linky = m.reference_linky GROUP BY 1
    HAVING count(*) >= 2 AND max(est_defectueux::INTEGER) = 1""",
)
def problem_meters(t):
    rows = t.complaints.join(t.meters.select("reference_linky", "est_defectueux", "nombre_incidents"), "reference_linky")
    return kpi.problem_meters(rows)
