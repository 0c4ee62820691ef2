"""Privacy, retention, freshness, job health and load."""

from pyspark.sql import functions as F

from gridvoice.operators import monitoring, privacy
from gridvoice.plans.registry import query
from gridvoice.sources import scratch, sinks
from gridvoice.sources.conform import EVENTS_AS_OF, register_sql_view

RUN = "2001-08-02"
_ERASE = "type_demande = 'OUBLI' AND statut IN ('EN_ATTENTE', 'EN_COURS')"


def erasures(t):
    return t.requests.filter((F.col("type_demande") == "OUBLI") & F.col("statut").isin(*privacy.PENDING))


@query(
    "t04_earliest_deadline_batch",
    f"SELECT id, client_id, date_limite_legal::VARCHAR AS date_limite_legal FROM requests WHERE {_ERASE} ORDER BY requests.date_limite_legal, id LIMIT 100",
)
def earliest_deadline_batch(t):
    return privacy.pending_erasures(t.requests).select("id", "client_id", "date_limite_legal")


@query(
    "p31_pseudonymised",
    f"""SELECT id_reclamation, CASE WHEN client_id IN (SELECT client_id FROM requests WHERE {_ERASE})
      THEN 'SUPPRIME_' || left(sha256(client_id || '_rgpd_{RUN}'), 12) ELSE client_id::VARCHAR END AS client_id, type_reclamation FROM tickets""",
)
def pseudonymised(t):
    rows = t.complaints.select("id_reclamation", "client_id", "type_reclamation")
    return privacy.pseudonymise(rows, erasures(t), RUN)


@query(
    "a55_erasure_audit",
    f"""WITH c AS (SELECT client_id, count(*) AS n, 'reclamations' AS nom FROM tickets GROUP BY 1
      UNION ALL SELECT client_id, count(*), 'compteurs' FROM meters GROUP BY 1
      UNION ALL SELECT client_id, count(*), 'notifications' FROM notifications GROUP BY 1)
    SELECT r.id, r.client_id, coalesce(sum(n), 0)::BIGINT AS nb_lignes, coalesce(string_agg(nom, ',' ORDER BY nom), '') AS tables_impactees
    FROM requests r LEFT JOIN c ON r.client_id = c.client_id WHERE {_ERASE} GROUP BY 1, 2""",
)
def erasure_audit(t):
    tables = {
        "reclamations": t.complaints,
        "compteurs": t.meters,
        "notifications": t.notifications,
        "factures": t.invoices,
    }
    audit = privacy.erasure_audit(tables, erasures(t))
    return audit.withColumn("tables_impactees", F.array_join("tables_impactees", ","))


@query(
    "p20_retention_cutoff",
    f"""SELECT type_reclamation, count(*) AS nb FROM tickets WHERE date_creation >= DATE '{RUN}' - 730 GROUP BY 1""",
)
def retention_cutoff(t):
    kept = privacy.retained(t.complaints, "date_creation", RUN, days=730)
    return kept.groupBy("type_reclamation").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "a42_retention_overruns",
    f"""SELECT *, CASE WHEN nb_lignes > 0 THEN 'ALERTE' ELSE 'OK' END AS statut FROM (
      SELECT 'reclamations' AS table_cible, 1825 AS retention_jours, count(*) FILTER (WHERE date_creation < DATE '{RUN}' - 1825) AS nb_lignes FROM tickets
      UNION ALL SELECT 'compteurs_detail', 1095, count(*) FILTER (WHERE export_date < DATE '{RUN}' - 1095) FROM linky_detail
      UNION ALL SELECT 'executions', 730, count(*) FILTER (WHERE created_at < DATE '{RUN}' - 730) FROM runs)""",
)
def retention_overruns(t):
    tables = {"reclamations": t.complaints, "compteurs_detail": t.linky_detail, "executions": t.runs, "compteurs": t.meters}
    policy = {"reclamations": 5 * 365, "compteurs_detail": 3 * 365, "executions": 2 * 365, "compteurs": 365}
    return privacy.retention_overruns(tables, policy, RUN)


@query(
    "a43_archive_scope",
    f"""SELECT count(*) FILTER (WHERE date_creation < DATE '2000-08-02') AS archivees, count(*) FILTER (WHERE date_creation < DATE '2000-08-02') AS supprimees,
      count(*) FILTER (WHERE date_creation >= DATE '2000-08-02' OR date_creation IS NULL) AS conservees, TRUE AS coherent FROM tickets""",
)
def archive_scope(t):
    """The table is written, archived and read again; the counts are those of the files."""
    root = scratch.new_path(t.spark, "archive")
    sinks.write_parquet(t.complaints, f"{root}/table")
    sinks.archive_table(t.spark, f"{root}/table", f"{root}/kept", f"{root}/old", "date_creation", RUN, 12)
    read = t.spark.read.parquet
    return privacy.archive_check(read(f"{root}/table"), read(f"{root}/old/{RUN}"), read(f"{root}/kept"))


@query(
    "a44_overdue_requests",
    f"""SELECT type_demande, count(*) AS nb FROM requests WHERE statut NOT IN ('TRAITE', 'REJETE') AND date_limite_legal < DATE '{RUN}' GROUP BY 1""",
)
def overdue_requests(t):
    return privacy.overdue_requests(t.requests, RUN)


@query("a44_request_status", "SELECT type_demande, statut, count(*) AS nb FROM requests GROUP BY 1, 2")
def request_status(t):
    return privacy.status_report(t.requests)


THRESHOLDS = {"executions": 2, "notifications": 26, "kpis": 72, "compteurs": 26}


def fresh_tables(t):
    return {
        "executions": t.runs,
        "notifications": t.notifications,
        "kpis": t.daily_kpi.withColumnRenamed("date_calcul", "export_date"),
        "compteurs": t.meters,
    }


_FRESH = f"""SELECT *, coalesce(age_heures <= seuil_heures, FALSE) AS a_jour,
    CASE WHEN NOT coalesce(age_heures <= seuil_heures, FALSE) THEN CASE WHEN nom_table = 'kpis' THEN 'CRITIQUE' ELSE 'ATTENTION' END END AS niveau_alerte FROM (
  SELECT nom_table, seuil_heures, round(((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') // 1000000 - epoch_us(derniere) // 1000000) / 3600.0::DOUBLE)::DECIMAL(28,8), 2)::DOUBLE AS age_heures FROM (
    SELECT 'executions' AS nom_table, max(created_at) AS derniere, 2.0::DOUBLE AS seuil_heures FROM runs
    UNION ALL SELECT 'notifications', max(created_at), 26.0 FROM notifications
    UNION ALL SELECT 'kpis', max(date_calcul)::TIMESTAMP, 72.0 FROM daily_kpi
    UNION ALL SELECT 'compteurs', NULL, 26.0))"""


@query("a40_freshness", _FRESH)
def freshness(t):
    return monitoring.freshness(fresh_tables(t), THRESHOLDS, EVENTS_AS_OF, critical=["kpis"])


@query(
    "a40_freshness_score",
    f"""SELECT count(*) AS nb_tables, count(*) FILTER (WHERE a_jour) AS nb_a_jour, round((avg(a_jour::INTEGER) * 100)::DECIMAL(28,8), 1)::DOUBLE AS score,
      CASE WHEN avg(a_jour::INTEGER) * 100 >= 95 THEN 'OK' WHEN avg(a_jour::INTEGER) * 100 >= 80 THEN 'WARNING' ELSE 'ALERT' END AS statut FROM ({_FRESH})""",
)
def freshness_score(t):
    return monitoring.freshness_score(monitoring.freshness(fresh_tables(t), THRESHOLDS, EVENTS_AS_OF))


MAX_ABSENCE = {"click": 26, "error": 26, "purchase": 26, "signup": 200, "view": 26, "refund": 26}
SLOW = {"click": 20, "error": 300, "purchase": 10, "view": 30}
_STATES = f"""SELECT p.dag_id, r.status, round(r.duration_seconds, 4) AS duration_seconds,
    round(((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') // 1000000 - epoch_us(r.created_at) // 1000000) / 3600.0::DOUBLE)::DECIMAL(28,8), 2)::DOUBLE AS age_h,
    CASE WHEN r.created_at IS NULL OR (epoch_us(TIMESTAMP '{EVENTS_AS_OF}') // 1000000 - epoch_us(r.created_at) // 1000000) / 3600.0::DOUBLE > p.absence THEN 'MANQUANT'
      WHEN r.status IN ('FAILED', 'ERROR', 'ALERT') THEN 'ECHEC' ELSE 'OK' END AS etat, p.lent AS seuil
  FROM (VALUES ('click', 26, 20), ('error', 26, 300), ('purchase', 26, 10), ('signup', 200, NULL), ('view', 26, 30), ('refund', 26, NULL)) p(dag_id, absence, lent)
  LEFT JOIN (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY dag_id ORDER BY created_at DESC, rows_processed DESC) = 1) r ON p.dag_id = r.dag_id"""


def states(t):
    return monitoring.job_states(t.runs, monitoring.policy_frame(t.spark, MAX_ABSENCE, SLOW), EVENTS_AS_OF)


@query(
    "a41_job_states",
    f"SELECT dag_id, status, duration_seconds, age_h, etat, etat = 'OK' AND coalesce(duration_seconds > seuil, FALSE) AS lent FROM ({_STATES})",
)
def job_states(t):
    return states(t)


_COUNTS = f"""SELECT count(*) AS n, count(*) FILTER (WHERE etat = 'OK') AS ok, count(*) FILTER (WHERE etat = 'OK' AND duration_seconds > seuil) AS slow,
    count(*) FILTER (WHERE etat = 'ECHEC') AS failed, count(*) FILTER (WHERE etat = 'MANQUANT') AS missing FROM ({_STATES})"""


@query(
    "a41_health_score",
    f"""SELECT ok AS nb_ok, slow AS nb_lents, failed AS nb_echecs, missing AS nb_manquants, score,
      CASE WHEN score >= 90 THEN 'OK' WHEN score >= 70 THEN 'WARNING' ELSE 'CRITICAL' END AS statut
    FROM (SELECT *, greatest(0.0::DOUBLE, least(100.0::DOUBLE, round((100 * (ok + slow * 0.7::DOUBLE - failed * 0.5::DOUBLE) / n)::DECIMAL(28,8), 1)::DOUBLE)) AS score FROM ({_COUNTS}))""",
)
def health_score(t):
    return monitoring.health_score(states(t))


# Baseline scaled so that the given events cover several load levels.
PER_DAY = 120
_RATIO = f"volume / ({PER_DAY} / 24.0::DOUBLE)"
_LOAD = f"""round(({_RATIO})::DECIMAL(28,8), 2)::DOUBLE AS ratio_baseline,
  CASE WHEN {_RATIO} >= 10 THEN 'CRISE' WHEN {_RATIO} >= 5 THEN 'CRITIQUE' WHEN {_RATIO} >= 2 THEN 'ELEVE' ELSE 'NORMAL' END AS niveau_charge,
  {_RATIO} >= 5 AS mode_degrade,
  CASE WHEN {_RATIO} >= 10 THEN 3 WHEN {_RATIO} >= 5 THEN 2 WHEN {_RATIO} >= 2 THEN 1 ELSE 0 END AS niveau_degrade"""
register_sql_view("hours", "SELECT date_trunc('hour', ts) AS heure, count(*) AS volume FROM events GROUP BY 1")


@query("p29_hourly_load_level", f"SELECT strftime(heure, '%Y-%m-%d %H:%M:%S') AS heure, volume, {_LOAD} FROM hours")
def hourly_load_level(t):
    return monitoring.hourly_load(t.event_tickets, PER_DAY)


@query(
    "a45_last_hour_load",
    f"""SELECT volume, {_LOAD} FROM (SELECT count(*) AS volume FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 HOUR AND ts < TIMESTAMP '{EVENTS_AS_OF}')""",
)
def last_hour_load(t):
    return monitoring.last_hour_load(t.event_tickets, EVENTS_AS_OF, PER_DAY)


@query(
    "a45_recovery_check",
    f"""SELECT 2 - count(*) AS heures_stables, 2 - count(*) >= 2 AS retour_normal FROM (
      SELECT date_trunc('hour', ts) AS h, count(*) AS volume FROM events
      WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 HOURS AND ts < TIMESTAMP '{EVENTS_AS_OF}' GROUP BY 1) WHERE {_RATIO} >= 5""",
)
def recovery_check(t):
    return monitoring.recovery(t.event_tickets, EVENTS_AS_OF, per_day=PER_DAY)


@query(
    "p36_status_bands",
    """SELECT dag_id, CASE WHEN 100.0 - 50 * n / t >= 95 THEN 'OK' WHEN 100.0 - 50 * n / t >= 80 THEN 'WARNING' ELSE 'ALERT' END AS statut
    FROM (SELECT dag_id, count(*) FILTER (WHERE status = 'FAILED') AS n, count(*) AS t FROM runs GROUP BY 1)""",
)
def status_bands(t):
    failed = F.count_if(F.col("status") == "FAILED")
    scores = t.runs.groupBy("dag_id").agg((100.0 - 50 * failed / F.count(F.lit(1))).alias("score"))
    return scores.select("dag_id", monitoring.status_band("score", 95, 80).alias("statut"))
