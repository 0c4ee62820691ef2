"""Outage clusters, incidents and missing incident notices."""

from pyspark.sql import functions as F

from gridvoice.operators import clusters, notices
from gridvoice.plans.registry import query
from gridvoice.sources.conform import EVENTS_AS_OF, register_sql_view

MIN_CLIENTS = 4
DAY = "2024-01-20"

register_sql_view(
    "open_outages",
    """SELECT id_reclamation, client_id, region, departement, date_creation,
        time_bucket(INTERVAL 2 HOURS, date_creation, TIMESTAMP '2024-01-01 00:00:00') AS fenetre_debut
      FROM event_tickets WHERE type_reclamation = 'COUPURE_ELECTRIQUE' AND statut IN ('OUVERT', 'EN_COURS')""",
)
register_sql_view(
    "clusters",
    f"""SELECT region, departement, fenetre_debut, count(DISTINCT client_id) AS nb_clients, count(DISTINCT id_reclamation) AS nb_reclamations,
        min(date_creation) AS debut_incident, max(date_creation) AS fin_periode
      FROM open_outages GROUP BY 1, 2, 3 HAVING count(DISTINCT client_id) >= {MIN_CLIENTS}""",
)
# Incidents already known: the clusters of every second window, entered half an hour late.
register_sql_view(
    "known_incidents",
    """SELECT 'OLD-' || departement || '-' || strftime(fenetre_debut, '%Y%m%d%H') AS incident_id, fin_periode AS date_detection,
        debut_incident + INTERVAL 30 MINUTES AS date_debut_incident, region, departement, 'MINEUR' AS niveau_severite,
        5::BIGINT AS nb_clients_affectes, 5::BIGINT AS nb_reclamations_liees,
        CASE WHEN hour(fenetre_debut) = 0 THEN 'RESOLU' ELSE 'EN_COURS' END AS statut
      FROM clusters WHERE hour(fenetre_debut) % 4 = 0""",
)
register_sql_view(
    "matched_clusters",
    """SELECT c.*, coalesce(k.known, 'INC-' || c.departement || '-' || strftime(c.fenetre_debut, '%Y%m%d%H') || '-' || lpad(c.nb_clients::VARCHAR, greatest(4, length(c.nb_clients::VARCHAR))::INTEGER, '0')) AS incident_id,
        k.known IS NOT NULL AS existant
      FROM clusters c LEFT JOIN (SELECT c.region, c.departement, c.fenetre_debut, min(i.incident_id) AS known
        FROM clusters c JOIN known_incidents i ON i.departement = c.departement AND i.statut <> 'RESOLU'
          AND i.date_debut_incident BETWEEN c.debut_incident - INTERVAL 1 HOUR AND c.debut_incident + INTERVAL 2 HOURS
        GROUP BY 1, 2, 3) k ON c.region = k.region AND c.departement = k.departement AND c.fenetre_debut = k.fenetre_debut""",
)
_SEVERITY = "CASE WHEN {0} >= 500 THEN 'CRITIQUE' WHEN {0} >= 100 THEN 'MAJEUR' WHEN {0} >= 30 THEN 'MODERE' ELSE 'MINEUR' END"
register_sql_view(
    "merged_incidents",
    f"""SELECT k.incident_id, k.date_detection, k.date_debut_incident, k.region, k.departement, k.niveau_severite,
        greatest(k.nb_clients_affectes, m.c) AS nb_clients_affectes, greatest(k.nb_reclamations_liees, m.r) AS nb_reclamations_liees, k.statut
      FROM known_incidents k LEFT JOIN (SELECT incident_id, max(nb_clients) AS c, max(nb_reclamations) AS r FROM matched_clusters WHERE existant GROUP BY 1) m
        ON k.incident_id = m.incident_id
      UNION ALL SELECT incident_id, fin_periode, debut_incident, region, departement, {_SEVERITY.format('nb_clients')}, nb_clients, nb_reclamations, 'DETECTE'
      FROM matched_clusters WHERE NOT existant""",
)
register_sql_view(
    "incident_links",
    """SELECT DISTINCT o.id_reclamation, o.client_id, m.incident_id FROM open_outages o JOIN matched_clusters m
      ON o.region = m.region AND o.departement = m.departement AND o.fenetre_debut = m.fenetre_debut""",
)


def found(t):
    """Clusters, written once: the incident steps below use them several times."""
    return t.kept("clusters", lambda: clusters.clusters(clusters.open_outages(t.event_tickets), MIN_CLIENTS))


def known_incidents(t):
    rows = found(t).filter(F.hour("fenetre_debut") % 4 == 0)
    return rows.select(
        F.concat(F.lit("OLD-"), F.col("departement"), F.lit("-"), F.date_format("fenetre_debut", "yyyyMMddHH")).alias("incident_id"),
        F.col("fin_periode").alias("date_detection"),
        (F.col("debut_incident") + F.expr("INTERVAL 30 MINUTES")).alias("date_debut_incident"),
        "region",
        "departement",
        F.lit("MINEUR").alias("niveau_severite"),
        F.lit(5).cast("long").alias("nb_clients_affectes"),
        F.lit(5).cast("long").alias("nb_reclamations_liees"),
        F.when(F.hour("fenetre_debut") == 0, "RESOLU").otherwise("EN_COURS").alias("statut"),
    )


def matched(t):
    return clusters.match_open_incidents(found(t), known_incidents(t))


def merged(t):
    return clusters.merge_incidents(matched(t), known_incidents(t))


def links(t):
    return clusters.members(clusters.open_outages(t.event_tickets), matched(t))


_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@query(
    "a15_outage_clusters",
    f"""SELECT region, departement, {_TS.format('fenetre_debut')} AS fenetre_debut, nb_clients, nb_reclamations,
      {_TS.format('debut_incident')} AS debut, {_TS.format('fin_periode')} AS fin FROM clusters""",
)
def outage_clusters(t):
    text = "yyyy-MM-dd HH:mm:ss"
    return found(t).select(
        "region", "departement", F.date_format("fenetre_debut", text).alias("fenetre_debut"), "nb_clients",
        "nb_reclamations", F.date_format("debut_incident", text).alias("debut"), F.date_format("fin_periode", text).alias("fin"),
    )


@query("a15_cluster_members", "SELECT id_reclamation, incident_id FROM incident_links")
def cluster_members(t):
    return links(t).select("id_reclamation", "incident_id")


@query(
    "p26_cluster_severity",
    f"""SELECT nb_clients * 20 AS taille, {_SEVERITY.format('nb_clients * 20')} AS niveau_severite, count(*) AS nb FROM clusters GROUP BY 1, 2""",
)
def cluster_severity(t):
    size = F.col("nb_clients") * 20
    return found(t).groupBy(size.alias("taille"), clusters.severity(size).alias("niveau_severite")).agg(
        F.count(F.lit(1)).alias("nb")
    )


@query(
    "p27_incident_key",
    """SELECT 'INC-' || departement || '-' || strftime(fenetre_debut, '%Y%m%d%H') || '-' || lpad(nb_clients::VARCHAR, greatest(4, length(nb_clients::VARCHAR))::INTEGER, '0') AS incident_id, nb_clients FROM clusters""",
)
def incident_key(t):
    return found(t).select(clusters.incident_key().alias("incident_id"), "nb_clients")


@query(
    "t07_clusters_by_size",
    f"""SELECT region, {_TS.format('fenetre_debut')} AS fenetre, nb_clients FROM clusters ORDER BY nb_clients DESC, region, departement, fenetre_debut""",
)
def clusters_by_size(t):
    return clusters.by_size(found(t)).select(
        "region", F.date_format("fenetre_debut", "yyyy-MM-dd HH:mm:ss").alias("fenetre"), "nb_clients"
    )


@query(
    "j19_incident_merge",
    "SELECT incident_id, departement, niveau_severite, nb_clients_affectes, nb_reclamations_liees, statut FROM merged_incidents",
)
def incident_merge(t):
    return merged(t).select(
        "incident_id", "departement", "niveau_severite", "nb_clients_affectes", "nb_reclamations_liees", "statut"
    )


@query(
    "a16_incident_report",
    "SELECT niveau_severite, statut, count(*) AS nb, sum(nb_clients_affectes)::BIGINT AS clients FROM merged_incidents GROUP BY 1, 2",
)
def incident_report(t):
    return clusters.report(merged(t))


@query(
    "j09_resolved_incidents",
    """SELECT incident_id, CASE WHEN statut IN ('DETECTE', 'EN_COURS') AND NOT EXISTS (SELECT 1 FROM incident_links l JOIN event_tickets e
        ON l.id_reclamation = e.id_reclamation WHERE l.incident_id = m.incident_id AND e.statut = 'OUVERT') THEN 'RESOLU' ELSE statut END AS statut
    FROM merged_incidents m""",
)
def resolved_incidents(t):
    pending = t.event_tickets.filter(F.col("statut") == "OUVERT")
    return clusters.resolve_finished(merged(t), links(t), pending, EVENTS_AS_OF).select("incident_id", "statut")


@query(
    "j13_missing_incident_notices",
    f"""SELECT l.id_reclamation, l.client_id, 'INCIDENT_SYSTEMIQUE' AS type_notification_manquante, TRUE AS echeance_depassee,
      round(epoch_us(TIMESTAMP '{EVENTS_AS_OF}') // 1000000 / 3600.0::DOUBLE - epoch_us(m.date_detection) // 1000000 / 3600.0::DOUBLE - 2, 4) AS heures_de_retard
    FROM incident_links l JOIN merged_incidents m ON l.incident_id = m.incident_id
    LEFT JOIN notifications n ON n.client_id = l.client_id AND n.type_notification = 'INCIDENT_SYSTEMIQUE' AND n.date_envoi >= m.date_detection
    WHERE n.id IS NULL AND TIMESTAMP '{EVENTS_AS_OF}' - m.date_detection > INTERVAL 2 HOURS""",
)
def missing_incident_notices(t):
    return notices.missing_incident_notices(links(t), merged(t), t.notifications, None, EVENTS_AS_OF)
