"""Fraud signals, scores and surveillance."""

from pyspark.sql import functions as F

from gridvoice.operators import fraud
from gridvoice.plans.registry import query
from gridvoice.sources.conform import register_sql_view

DAY = "2024-01-20"
MIN_ZERO = 3

register_sql_view(
    "zero_rows",
    """SELECT d.id_reclamation, numero_compteur, consommation_kwh, client_id FROM linky_detail d
      JOIN event_tickets e ON d.id_reclamation = e.id_reclamation
      WHERE consommation_kwh = 0 AND numero_compteur IS NOT NULL AND statut <> 'CLOTURE'""",
)


def zero_sql(minimum: int) -> str:
    return f"""SELECT DATE '{DAY}' AS date_detection, numero_compteur, client_id, 'CONSO_NULLE' AS type_anomalie,
        CASE WHEN count(*) > 30 THEN 'CRITIQUE' WHEN count(*) > 14 THEN 'ELEVEE' WHEN count(*) > {minimum} THEN 'MODEREE' ELSE 'FAIBLE' END AS severite,
        0.0::DOUBLE AS valeur_mesuree, avg(consommation_kwh) AS valeur_attendue, 100.0::DOUBLE AS ecart_pct, count(*) AS nb_jours_anomalie
      FROM zero_rows GROUP BY numero_compteur, client_id HAVING count(*) >= {minimum}"""


_DELTA = f"""SELECT DATE '{DAY}' AS date_detection, numero_compteur, client_id, 'DELTA_INDEX' AS type_anomalie,
        CASE WHEN abs(ecart_index_pct) > 20 THEN 'CRITIQUE' WHEN abs(ecart_index_pct) > 10 THEN 'ELEVEE' ELSE 'MODEREE' END AS severite,
        consommation_kwh AS valeur_mesuree, consommation_kwh * (1 + ecart_index_pct / 100.0::DOUBLE) AS valeur_attendue,
        ecart_index_pct AS ecart_pct, 1::BIGINT AS nb_jours_anomalie
      FROM linky_detail d JOIN event_tickets e ON d.id_reclamation = e.id_reclamation
      WHERE numero_compteur IS NOT NULL AND abs(ecart_index_pct) > 5 AND export_date = DATE '{DAY}'"""
_OUTAGE = f"""SELECT DISTINCT DATE '{DAY}' AS date_detection, numero_compteur, e.client_id, 'CONSO_PENDANT_COUPURE' AS type_anomalie, 'CRITIQUE' AS severite,
        consommation_kwh AS valeur_mesuree, NULL::DOUBLE AS valeur_attendue, NULL::DOUBLE AS ecart_pct, 1::BIGINT AS nb_jours_anomalie
      FROM linky_detail d JOIN event_tickets e ON d.id_reclamation = e.id_reclamation
      JOIN event_tickets c ON c.client_id = e.client_id AND c.type_reclamation = 'COUPURE_ELECTRIQUE' AND c.statut IN ('OUVERT', 'EN_COURS')
      WHERE numero_compteur IS NOT NULL AND consommation_kwh > 0 AND export_date = DATE '{DAY}'"""
register_sql_view("meter_anomalies", f"{zero_sql(MIN_ZERO)} UNION ALL {_DELTA} UNION ALL {_OUTAGE}")
register_sql_view(
    "suspicions",
    f"""SELECT numero_compteur, max(client_id) AS client_id, min(date_detection) AS date_premiere_anomalie, count(*) AS nb_anomalies_30j,
        least(100.0::DOUBLE, round((sum(CASE type_anomalie WHEN 'CONSO_PENDANT_COUPURE' THEN 40 WHEN 'DELTA_INDEX' THEN 25 WHEN 'CONSO_NULLE' THEN 15 ELSE 10 END
          * CASE severite WHEN 'CRITIQUE' THEN 2.0::DOUBLE WHEN 'ELEVEE' THEN 1.5 WHEN 'MODEREE' THEN 1.0 ELSE 0.5 END))::DECIMAL(28,8), 2)::DOUBLE) AS score_fraude,
        CASE WHEN count(*) >= 3 AND bool_or(type_anomalie = 'CONSO_PENDANT_COUPURE') THEN 'CONFIRME' WHEN count(*) >= 4 THEN 'ELEVE' ELSE 'MODERE' END AS niveau_risque
      FROM meter_anomalies WHERE date_detection >= DATE '{DAY}' - 30 GROUP BY numero_compteur HAVING count(*) >= 2""",
)

_SHOWN = """date_detection::VARCHAR AS date_detection, numero_compteur, client_id, type_anomalie, severite, round(valeur_mesuree, 4) AS valeur_mesuree,
  round(valeur_attendue, 4) AS valeur_attendue, round(ecart_pct, 4) AS ecart_pct, nb_jours_anomalie"""


def outages(t):
    return t.event_tickets.filter(F.col("type_reclamation") == "COUPURE_ELECTRIQUE")


def meter_anomalies(t):
    return fraud.meter_anomalies(t.linky_detail, t.event_tickets, outages(t), DAY, MIN_ZERO)


@query("j21_zero_readings", "SELECT id_reclamation, numero_compteur, client_id FROM zero_rows")
def zero_readings(t):
    return fraud.zero_readings(t.linky_detail, t.event_tickets).select("id_reclamation", "numero_compteur", "client_id")


@query("a13_zero_consumption", f"SELECT {_SHOWN} FROM ({zero_sql(7)})")
def zero_consumption(t):
    return fraud.zero_consumption(t.linky_detail, t.event_tickets, DAY)


@query("p28_index_delta", f"SELECT {_SHOWN} FROM ({_DELTA})")
def index_delta(t):
    return fraud.index_delta(t.linky_detail, t.event_tickets, DAY)


@query("j12_consumption_during_outage", f"SELECT {_SHOWN} FROM ({_OUTAGE})")
def consumption_during_outage(t):
    return fraud.consumption_during_outage(t.linky_detail, t.event_tickets, outages(t), DAY)


@query("u02_fraud_union", "SELECT type_anomalie, severite, count(*) AS nb FROM meter_anomalies GROUP BY 1, 2")
def fraud_union(t):
    return meter_anomalies(t).groupBy("type_anomalie", "severite").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "a14_fraud_scores",
    """SELECT numero_compteur, client_id, date_premiere_anomalie::VARCHAR AS date_premiere_anomalie, nb_anomalies_30j, score_fraude, niveau_risque
    FROM suspicions""",
)
def fraud_scores(t):
    return fraud.scores(meter_anomalies(t), DAY)


_WATCHED = "SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND value > 300"


@query(
    "p37_surveillance",
    f"""SELECT numero_compteur, '{DAY}' AS date_mise_surveillance, 'Score fraude ' || score_fraude::DECIMAL(5,2)::VARCHAR || '/100 — niveau ' || niveau_risque AS motif,
      (DATE '{DAY}' + 7)::VARCHAR AS prochain_controle FROM suspicions
    WHERE niveau_risque IN ('ELEVE', 'CONFIRME') AND numero_compteur NOT IN ({_WATCHED})""",
)
def surveillance(t):
    watched = t.raw("events").filter((F.col("event_type") == "signup") & (F.col("value") > 300))
    return fraud.to_watch(
        fraud.scores(meter_anomalies(t), DAY), watched.select(F.col("user_id").alias("numero_compteur")), DAY
    )


@query(
    "a56_consumption_peaks",
    """SELECT numero_compteur, date_releve::VARCHAR AS date_releve, round(consommation_kwh, 4) AS consommation_kwh, round(moyenne, 4) AS moyenne, round(ecart_type, 4) AS ecart_type
    FROM (SELECT *, avg(consommation_kwh) OVER (PARTITION BY numero_compteur) AS moyenne,
      stddev_samp(consommation_kwh) OVER (PARTITION BY numero_compteur) AS ecart_type FROM readings)
    WHERE consommation_kwh > moyenne + 3 * ecart_type""",
)
def consumption_peaks(t):
    return fraud.consumption_peaks(t.readings).select(
        "numero_compteur", "date_releve", "consommation_kwh", "moyenne", "ecart_type"
    )


@query(
    "j25_twin_profiles",
    """WITH d AS (SELECT zone, numero_compteur, date_releve, floor(sum(consommation_kwh) / 50)::BIGINT AS bande FROM readings GROUP BY 1, 2, 3),
    p AS (SELECT zone, numero_compteur, count(*) AS nb_jours, string_agg(date_releve || ':' || bande, ',' ORDER BY date_releve) AS profil FROM d GROUP BY 1, 2)
    SELECT zone, numero_compteur, nb_jours, count(*) OVER w AS nb_compteurs, min(numero_compteur) OVER w AS premier_compteur
    FROM p WINDOW w AS (PARTITION BY zone, profil) QUALIFY count(*) OVER w > 1""",
)
def twin_profiles(t):
    return fraud.twin_profiles(t.readings)
