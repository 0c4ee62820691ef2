"""Streaming checks over the event files, run to completion, and their SQL twins on closed windows."""

from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.plans.governance import PER_DAY
from gridvoice.plans.incidents import MIN_CLIENTS
from gridvoice.plans.registry import query
from gridvoice.sources import scratch, versions
from gridvoice.sources.conform import EVENTS_AS_OF, Tables, pick, register_sql_view
from gridvoice.streaming import arrivals, checks, incidents, serving

register_sql_view("closed", "SELECT max(ts) - INTERVAL 1 HOUR AS limite FROM events")


def complaint_stream(t):
    """Complaints as a stream of the event file (region ids instead of names: no join needed)."""
    schema = t.raw("events").schema
    k, u = F.col("event_id"), F.col("user_id")
    return checks.read_parquet_stream(t.spark, f"{t.directory}/events.parquet", schema).select(
        k.alias("id_reclamation"),
        u.alias("client_id"),
        Tables.event_complaint_type().alias("type_reclamation"),
        pick(k % 4, ["CLOTURE", "OUVERT", "EN_COURS", "OUVERT"]).alias("statut"),
        (u % 5).alias("region"),
        F.concat(F.lit("D"), (u % 5).cast("string")).alias("departement"),
        "event_type",
        F.col("ts").cast("timestamp").alias("date_creation"),
    )


def finished(t, stream, name, run=checks.run_to_parquet):
    root = scratch.new_path(t.spark, name)
    run(stream, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/rows")


def second(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


_RATIO = f"volume / ({PER_DAY} / 24.0::DOUBLE)"


@query(
    "st1_stream_hourly_load",
    f"""SELECT strftime(heure, '%Y-%m-%d %H:%M:%S') AS heure, volume, round(({_RATIO})::DECIMAL(28,8), 2)::DOUBLE AS ratio_baseline,
      CASE WHEN {_RATIO} >= 10 THEN 'CRISE' WHEN {_RATIO} >= 5 THEN 'CRITIQUE' WHEN {_RATIO} >= 2 THEN 'ELEVE' ELSE 'NORMAL' END AS niveau_charge,
      {_RATIO} >= 5 AS mode_degrade, CASE WHEN {_RATIO} >= 10 THEN 3 WHEN {_RATIO} >= 5 THEN 2 WHEN {_RATIO} >= 2 THEN 1 ELSE 0 END AS niveau_degrade
    FROM hours WHERE heure + INTERVAL 1 HOUR <= (SELECT limite FROM closed)""",
)
def stream_hourly_load(t):
    return finished(t, checks.hourly_load(complaint_stream(t), PER_DAY), "st1")


def served(t, stream, name, keys):
    root = scratch.new_path(t.spark, name)
    serving.serve(stream, f"{root}/table", keys, f"{root}/checkpoint").awaitTermination()
    return versions.read(t.spark, f"{root}/table")


@query(
    "st1_serving_load",
    f"""SELECT strftime(heure, '%Y-%m-%d %H:%M:%S') AS heure, volume,
      CASE WHEN {_RATIO} >= 10 THEN 'CRISE' WHEN {_RATIO} >= 5 THEN 'CRITIQUE' WHEN {_RATIO} >= 2 THEN 'ELEVE' ELSE 'NORMAL' END AS niveau_charge FROM hours""",
)
def serving_load(t):
    """The load of every hour seen so far, hours that are not over included."""
    rows = served(t, checks.hourly_load(complaint_stream(t), PER_DAY), "st1_serving", ["heure"])
    return rows.select(second("heure"), "volume", "niveau_charge")


@query(
    "st2_stream_outage_clusters",
    f"""SELECT substr(departement, 2)::BIGINT AS region, departement, strftime(fenetre_debut, '%Y-%m-%d %H:%M:%S') AS fenetre_debut, nb_clients, nb_reclamations,
      strftime(debut_incident, '%Y-%m-%d %H:%M:%S') AS debut_incident, strftime(fin_periode, '%Y-%m-%d %H:%M:%S') AS fin_periode
    FROM clusters WHERE fenetre_debut + INTERVAL 2 HOURS <= (SELECT limite FROM closed)""",
)
def stream_outage_clusters(t):
    rows = finished(t, checks.outage_clusters(complaint_stream(t), MIN_CLIENTS), "st2")
    return rows.select(
        "region", "departement", second("fenetre_debut"), "nb_clients", "nb_reclamations", second("debut_incident"), second("fin_periode")
    )


@query(
    "j19_stream_incidents",
    """WITH c AS (SELECT *, lag(debut_incident) OVER (PARTITION BY departement ORDER BY fenetre_debut) AS avant FROM clusters
      WHERE fenetre_debut + INTERVAL 2 HOURS <= (SELECT limite FROM closed)),
    g AS (SELECT *, sum(CASE WHEN avant >= debut_incident - INTERVAL 1 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY departement ORDER BY fenetre_debut) AS suite FROM c),
    p AS (SELECT *, (row_number() OVER (PARTITION BY departement, suite ORDER BY fenetre_debut) + 1) // 2 AS paire FROM g),
    i AS (SELECT departement, arg_min('INC-' || departement || '-' || strftime(fenetre_debut, '%Y%m%d%H') || '-'
        || lpad(nb_clients::VARCHAR, greatest(4, length(nb_clients::VARCHAR))::INTEGER, '0'), fenetre_debut) AS incident_id,
      max(nb_clients) AS nb_clients_affectes, max(nb_reclamations) AS nb_reclamations_liees, min(debut_incident) AS debut,
      max(fenetre_debut) + INTERVAL 8 HOURS AS fin FROM p GROUP BY departement, suite, paire)
    SELECT departement, incident_id, strftime(debut, '%Y-%m-%d %H:%M:%S') AS date_debut_incident, nb_clients_affectes, nb_reclamations_liees,
      CASE WHEN fin <= limite THEN 'RESOLU' ELSE 'DETECTE' END AS statut, CASE WHEN fin <= limite THEN strftime(fin, '%Y-%m-%d %H:%M:%S') END AS date_fin_incident
    FROM i, closed""",
)
def stream_incidents(t):
    """Clusters of consecutive windows: a cluster joins the incident that the one before it opened, if that began at most an hour earlier."""
    found = checks.outage_clusters(complaint_stream(t), MIN_CLIENTS)
    changes = finished(t, incidents.track(found), "j19", lambda rows, path, state: incidents.start(t.spark, rows, path, state))
    return incidents.latest(changes).select(
        "departement",
        "incident_id",
        second("date_debut_incident"),
        "nb_clients_affectes",
        "nb_reclamations_liees",
        "statut",
        second("date_fin_incident"),
    )


@query(
    "st3_stream_freshness",
    f"""SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS derniere,
      round((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') // 1000000 - epoch_us(max(ts)) // 1000000) / 3600.0::DOUBLE, 4) AS age_heures FROM events GROUP BY 1""",
)
def stream_freshness(t):
    latest = checks.latest_per_source(complaint_stream(t), "event_type", "date_creation")
    root = scratch.new_path(t.spark, "st3")
    checks.run_latest(latest, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return versions.read(t.spark, f"{root}/table").select(
        "event_type", second("derniere"), C.hours_between(C.moment(EVENTS_AS_OF), F.col("derniere")).alias("age_heures")
    )


@query(
    "st3_serving_freshness",
    "SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS derniere FROM events GROUP BY 1",
)
def serving_freshness(t):
    latest = checks.latest_per_source(complaint_stream(t), "event_type", "date_creation")
    return served(t, latest, "st3_serving", ["event_type"]).select("event_type", second("derniere"))


@query(
    "st4_stream_duplicates",
    """SELECT CAST(date_creation AS DATE)::VARCHAR AS creation_day, client_id, type_reclamation, count(*) AS nb_reclamations
    FROM event_tickets WHERE CAST(date_creation AS DATE) + INTERVAL 1 DAY <= (SELECT limite FROM closed) GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def stream_duplicates(t):
    return finished(t, checks.daily_duplicates(complaint_stream(t)), "st4")


@query(
    "st4_duplicates_on_arrival",
    """SELECT CAST(date_creation AS DATE)::VARCHAR AS creation_day, client_id, type_reclamation, count(*) AS nb_reclamations, 1 AS nb_premieres,
      count(*) - 1 AS nb_repetees, 0 AS nb_tardives FROM event_tickets GROUP BY 1, 2, 3""",
)
def duplicates_on_arrival(t):
    rows = finished(t, complaint_stream(t), "st4_arrivals", arrivals.report)
    return rows.groupBy(F.col("jour").alias("creation_day"), "client_id", "type_reclamation").agg(
        F.count(F.lit(1)).alias("nb_reclamations"),
        F.count_if(F.col("etat") == arrivals.FIRST).alias("nb_premieres"),
        F.count_if(F.col("etat") == arrivals.REPEATED).alias("nb_repetees"),
        F.count_if(F.col("etat") == arrivals.LATE).alias("nb_tardives"),
    )


@query(
    "st5_stream_recovery",
    f"""WITH w AS (SELECT ts, unnest([date_trunc('hour', ts) - INTERVAL 1 HOUR, date_trunc('hour', ts)]) AS debut FROM events)
    SELECT strftime(debut, '%Y-%m-%d %H:%M:%S') AS debut, strftime(debut + INTERVAL 2 HOURS, '%Y-%m-%d %H:%M:%S') AS fin,
      count(*) FILTER (WHERE ts < debut + INTERVAL 1 HOUR) AS premiere_heure, count(*) FILTER (WHERE ts >= debut + INTERVAL 1 HOUR) AS seconde_heure,
      greatest(count(*) FILTER (WHERE ts < debut + INTERVAL 1 HOUR), count(*) FILTER (WHERE ts >= debut + INTERVAL 1 HOUR)) / ({PER_DAY} / 24.0::DOUBLE) < 5 AS stable
    FROM w WHERE debut + INTERVAL 2 HOURS <= (SELECT limite FROM closed) GROUP BY debut""",
)
def stream_recovery(t):
    return finished(t, checks.stable_windows(complaint_stream(t), PER_DAY), "st5")


@query(
    "a45_stable_windows",
    f"""WITH w AS (SELECT ts, unnest([date_trunc('hour', ts) - INTERVAL 1 HOUR, date_trunc('hour', ts)]) AS debut FROM events)
    SELECT strftime(debut, '%Y-%m-%d %H:%M:%S') AS debut, strftime(debut + INTERVAL 2 HOURS, '%Y-%m-%d %H:%M:%S') AS fin,
      count(*) FILTER (WHERE ts < debut + INTERVAL 1 HOUR) AS premiere_heure, count(*) FILTER (WHERE ts >= debut + INTERVAL 1 HOUR) AS seconde_heure,
      greatest(count(*) FILTER (WHERE ts < debut + INTERVAL 1 HOUR), count(*) FILTER (WHERE ts >= debut + INTERVAL 1 HOUR)) / ({PER_DAY} / 24.0::DOUBLE) < 5 AS stable
    FROM w GROUP BY debut""",
)
def stable_windows(t):
    """The same definition on a batch frame (a watermark has no effect there)."""
    return checks.stable_windows(t.event_tickets, PER_DAY)
