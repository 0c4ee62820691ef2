"""Readers, writers and merges on the given tables; each query writes, reads back and reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice import layers
from gridvoice.operators import enrich, kpi, merge, quality
from gridvoice.plans.enrichment import gold_enriched
from gridvoice.plans.periods import _FIGURES, RUN, consolidated, kpi_history
from gridvoice.plans.quality_checks import raw_tickets
from gridvoice.plans.registry import query
from gridvoice.sources import buckets, ledger, readers, schemas, scratch, sinks, versions
from gridvoice.sources.conform import AS_OF

_CSV_COLUMNS = ["id_reclamation", "client_id", "type_reclamation", "priorite", "statut", "date_creation", "date_cloture", "latitude"]
_SUMMARY = """SELECT type_reclamation, count(*) AS nb, count(date_cloture) AS nb_cloturees, round((sum(latitude))::DECIMAL(28,8), 2)::DOUBLE AS somme_latitude,
  strftime(max(date_creation), '%Y-%m-%d %H:%M:%S') AS derniere FROM tickets GROUP BY 1"""


def summary(df):
    return df.groupBy("type_reclamation").agg(
        F.count(F.lit(1)).alias("nb"),
        F.count("date_cloture").alias("nb_cloturees"),
        F.round(F.sum("latitude"), 2).alias("somme_latitude"),
        F.date_format(F.max("date_creation"), "yyyy-MM-dd HH:mm:ss").alias("derniere"),
    )


def exported(t, name):
    path = scratch.new_path(t.spark, name)
    rows = t.complaints.select(*_CSV_COLUMNS)
    text = {c: F.date_format(c, readers.TIMESTAMP_FORMAT) for c in ("date_creation", "date_cloture")}
    sinks.write_csv(rows.withColumns(text), path)
    return path


@query("s01_csv_declared_schema", _SUMMARY)
def csv_declared(t):
    declared = T.StructType.fromDDL(
        "id_reclamation BIGINT NOT NULL, client_id BIGINT NOT NULL, type_reclamation STRING NOT NULL, priorite STRING, "
        "statut STRING, date_creation TIMESTAMP NOT NULL, date_cloture TIMESTAMP, latitude DOUBLE"
    )
    return summary(readers.read_csv(t.spark, exported(t, "csv"), declared))


@query("s02_csv_inferred_schema", _SUMMARY)
def csv_inferred(t):
    return summary(readers.read_csv(t.spark, exported(t, "csv")))


@query("s03_parquet_scan", "SELECT o_orderstatus, count(*) AS nb FROM orders GROUP BY 1")
def parquet_scan(t):
    return (
        readers.read_parquet(t.spark, f"{t.directory}/orders.parquet")
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("nb"))
    )


@query(
    "s04_without_partition_columns",
    "SELECT region, count(*) AS nb, 3 AS nb_colonnes FROM tickets GROUP BY 1",
)
def without_partition_columns(t):
    rows = enrich.with_partition_columns(t.tickets).select("id_reclamation", "region", "statut", "annee", "mois")
    left = readers.drop_partition_columns(rows)
    return left.groupBy("region").agg(F.count(F.lit(1)).alias("nb"), F.lit(len(left.columns)).alias("nb_colonnes"))


@query(
    "s06_weather_csv",
    """SELECT departement::VARCHAR AS departement, region, round(sum(coalesce(CASE WHEN departement % 7 = 0 THEN NULL ELSE vent_rafales_ms END, 0)), 4) AS rafales,
      count(*) FILTER (WHERE vigilance_meteo = 'VERTE') AS nb_vertes, '2024-01-31' AS date_mesure
    FROM weather GROUP BY departement, region""",
)
def weather_csv(t):
    path = scratch.new_path(t.spark, "weather")
    gust = F.when(F.col("departement") % 7 != 0, F.col("vent_rafales_ms").cast("string")).otherwise("n/a")
    rows = t.weather.select(
        F.col("departement").cast("string").alias("departement"),
        "region",
        gust.alias("vent_rafales_ms"),
        F.lit("").alias("neige_cm"),
        F.when(F.col("vigilance_meteo") != "VERTE", F.col("vigilance_meteo")).alias("vigilance"),
    )
    sinks.write_csv(rows, path, sep=";")
    return (
        readers.read_weather_csv(t.spark, path, "2024-01-31")
        .groupBy("departement", "region", "date_mesure")
        .agg(F.sum("vent_rafales_ms").alias("rafales"), F.count_if(F.col("vigilance_meteo") == "VERTE").alias("nb_vertes"))
    )


_CONTRACT = {
    "c_custkey": "OK",
    "c_name": "OK",
    "c_nationkey": "OK",
    "c_acctbal": "SUPPLEMENTAIRE",
    "c_mktsegment": "SUPPLEMENTAIRE",
    "c_phone": "MANQUANTE",
}


@query(
    "s07_schema_contract",
    " UNION ALL ".join(
        f"SELECT '{c}' AS colonne, '{state}' AS etat, "
        + ("nullif(count(*), count(*))" if state == "MANQUANTE" else f"count(*) FILTER (WHERE {c} IS NULL)")
        + " AS nb_nulls FROM customer"
        for c, state in _CONTRACT.items()
    ),
)
def schema_contract(t):
    """State of each declared or present column, with the missing values of the present ones."""
    expected = T.StructType.fromDDL("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_phone STRING")
    customers = t.raw("customer")
    report = readers.contract_report(customers, expected).select("colonne", "etat")
    return report.join(quality.null_profile(customers).select("colonne", "nb_nulls"), "colonne", "left")


@query("s08_lineage", "SELECT 'orders.parquet' AS source_file, TRUE AS date_connue, count(*) AS nb FROM orders")
def lineage(t):
    return (
        readers.with_lineage(t.raw("orders"))
        .groupBy("source_file", F.col("ingestion_date").isNotNull().alias("date_connue"))
        .agg(F.count(F.lit(1)).alias("nb"))
    )


@query("s08_incremental_ingest", _SUMMARY.replace("SELECT type_reclamation", "SELECT type_reclamation, 2 AS nb_lots"))
def incremental_ingest(t):
    """Closed complaints are loaded first, the others when their files have come; a third run finds nothing to read."""
    source, root = scratch.new_path(t.spark, "incoming"), scratch.new_path(t.spark, "loaded")
    declared = T.StructType.fromDDL(
        "id_reclamation BIGINT, client_id BIGINT, type_reclamation STRING, priorite STRING, statut STRING, date_creation TIMESTAMP, "
        "date_cloture TIMESTAMP, latitude DOUBLE"
    )

    def read(spark, paths):
        return spark.read.option("header", True).option("timestampFormat", readers.TIMESTAMP_FORMAT).schema(declared).csv(paths)

    closed = F.col("statut") == "CLOTURE"
    text = {c: F.date_format(c, readers.TIMESTAMP_FORMAT) for c in ("date_creation", "date_cloture")}
    for part in (closed, ~closed, F.lit(False)):
        part_rows = t.complaints.select(*_CSV_COLUMNS).filter(part).withColumns(text)
        if not part_rows.isEmpty():
            part_rows.write.mode("append").option("header", True).csv(source)
        ledger.load_new(t.spark, source, root, read, "part-*")
    found = ledger.rows(t.spark, root)
    lots = found.groupBy("type_reclamation").agg(F.count_distinct("lot").alias("nb_lots"))
    return summary(found).join(lots, "type_reclamation")


@query("s10_parquet_overwrite", _SUMMARY)
def parquet_overwrite(t):
    path = scratch.new_path(t.spark, "overwrite")
    sinks.write_parquet(t.complaints, path)
    sinks.write_parquet(t.complaints, path)
    return summary(t.spark.read.parquet(path))


@query("s11_partitioned_write", "SELECT region, type_reclamation, count(*) AS nb FROM tickets GROUP BY 1, 2")
def partitioned_write(t):
    path = scratch.new_path(t.spark, "partitioned")
    sinks.write_parquet(t.tickets, path, ["region", "type_reclamation"])
    return t.spark.read.parquet(path).groupBy("region", "type_reclamation").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "s11_pruned_read",
    """SELECT region, annee, count(*) AS nb FROM (SELECT region, year(date_creation)::INTEGER AS annee FROM tickets)
    WHERE annee IN (SELECT annee FROM (SELECT year(date_creation)::INTEGER AS annee, count(*) AS n FROM tickets GROUP BY 1) WHERE annee % 2 = 0 AND n > 0) GROUP BY 1, 2""",
)
def pruned_read(t):
    """Even years of a table partitioned by year and region, picked by the rows of another table."""
    path, years = scratch.new_path(t.spark, "partitioned"), scratch.new_path(t.spark, "years")
    rows = enrich.with_partition_columns(t.tickets).select("id_reclamation", "region", "annee")
    sinks.write_parquet(rows, path, ["annee", "region"])
    sinks.write_parquet(rows.groupBy("annee").agg(F.count(F.lit(1)).alias("n")), years)
    selection = t.spark.read.parquet(years).filter((F.col("annee") % 2 == 0) & (F.col("n") > 0))
    found = readers.read_selected(t.spark, path, selection, ["annee"])
    return found.groupBy("region", "annee").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "s12_snapshot_rerun",
    """SELECT d AS date_calcul, region, type_reclamation, count(*) AS nombre_reclamations_total FROM tickets, (VALUES ('2001-08-02'), ('2001-08-03')) v(d) GROUP BY 1, 2, 3""",
)
def snapshot_rerun(t):
    path = scratch.new_path(t.spark, "snapshot")
    rows = gold_enriched(t)
    for day in ("2001-08-02", "2001-08-03", "2001-08-02"):
        sinks.write_snapshot(kpi.gold_daily(rows, day), path)
    return t.spark.read.parquet(path).select("date_calcul", "region", "type_reclamation", "nombre_reclamations_total")


@query("s14_csv_export", "SELECT count(*) AS nb, count(DISTINCT id_reclamation) AS nb_ids FROM tickets")
def csv_export(t):
    back = t.spark.read.option("header", True).csv(exported(t, "export"))
    return back.agg(F.count(F.lit(1)).alias("nb"), F.count_distinct("id_reclamation").alias("nb_ids"))


@query("s15_full_reload", "SELECT statut, count(*) AS nb FROM tickets WHERE statut <> 'CLOTURE' GROUP BY 1")
def full_reload(t):
    path = scratch.new_path(t.spark, "reload")
    sinks.reload(t.complaints, path)
    sinks.reload(t.complaints.filter(F.col("statut") != "CLOTURE"), path)
    return t.spark.read.parquet(path).groupBy("statut").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "s15_published_reload",
    """SELECT 'avant' AS lecture, statut, count(*) AS nb FROM tickets GROUP BY ALL
      UNION ALL SELECT 'apres', statut, count(*) FROM tickets WHERE statut <> 'CLOTURE' GROUP BY ALL""",
)
def published_reload(t):
    """A reload that fails its check, then one that passes, under a reader that began before both and one that begins after."""
    root = scratch.new_path(t.spark, "published")
    versions.publish(t.complaints, root, min_rows=1)
    before = versions.read(t.spark, root)
    try:
        versions.publish(t.complaints.filter("statut = 'INCONNU'"), root, min_rows=1)
    except versions.Rejected:
        versions.publish(t.complaints.filter(F.col("statut") != "CLOTURE"), root, min_rows=1)
    after = versions.read(t.spark, root)
    both = before.withColumn("lecture", F.lit("avant")).unionByName(after.withColumn("lecture", F.lit("apres")))
    return both.groupBy("lecture", "statut").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "s16_slice_replace",
    """SELECT year(date_creation)::INTEGER AS annee, count(*) AS nb, round((sum(CASE WHEN year(date_creation) = 1997 THEN montant * 2 ELSE montant END))::DECIMAL(28,8), 1)::DOUBLE AS montant
    FROM tickets GROUP BY 1""",
    digits=1,
)
def slice_replace(t):
    path = scratch.new_path(t.spark, "slice")
    rows = enrich.with_partition_columns(t.complaints).select("id_reclamation", "montant", "annee")
    sinks.write_parquet(rows, path, ["annee"])
    corrected = rows.filter(F.col("annee") == 1997).withColumn("montant", F.col("montant") * 2)
    for _ in range(2):
        sinks.replace_partitions(corrected, path, ["annee"])
    return (
        t.spark.read.parquet(path)
        .groupBy("annee")
        .agg(F.count(F.lit(1)).alias("nb"), F.sum(F.col("montant").cast("decimal(24,4)")).cast("double").alias("montant"))
    )


_UPSERT_SOURCE = """SELECT date_calcul + 1 AS date_calcul, region, type_reclamation, nombre_ouvertes + 1000 AS nombre_ouvertes, nombre_cloturees + 1000 AS nombre_cloturees
  FROM daily_kpi WHERE date_calcul >= DATE '2024-01-25'"""
_UPSERT = f"""SELECT coalesce(t.date_calcul, s.date_calcul)::VARCHAR AS date_calcul, coalesce(t.region, s.region) AS region,
    coalesce(t.type_reclamation, s.type_reclamation) AS type_reclamation, coalesce(s.nombre_ouvertes, t.nombre_ouvertes) AS nombre_ouvertes,
    CASE WHEN t.region IS NOT NULL THEN t.nombre_cloturees ELSE s.nombre_cloturees END AS nombre_cloturees
  FROM daily_kpi t FULL JOIN ({_UPSERT_SOURCE}) s ON t.date_calcul = s.date_calcul AND t.region = s.region AND t.type_reclamation = s.type_reclamation"""
_KEYS = ["date_calcul", "region", "type_reclamation"]


def upsert_inputs(t):
    target = t.daily_kpi.select(*_KEYS, "nombre_ouvertes", "nombre_cloturees")
    source = target.filter(F.col("date_calcul") >= F.lit("2024-01-25").cast("date")).withColumns(
        {
            "date_calcul": F.date_add("date_calcul", 1),
            "nombre_ouvertes": F.col("nombre_ouvertes") + 1000,
            "nombre_cloturees": F.col("nombre_cloturees") + 1000,
        }
    )
    return target, source


@query("s17_partial_upsert", _UPSERT)
def partial_upsert(t):
    return merge.upsert(*upsert_inputs(t), _KEYS, ["nombre_ouvertes"])


@query("s17_upsert_in_place", _UPSERT)
def upsert_in_place(t):
    target, source = upsert_inputs(t)
    path = scratch.new_path(t.spark, "upsert")
    sinks.write_parquet(target, path, ["date_calcul"])
    for _ in range(2):
        sinks.upsert_partitions(t.spark, path, source, _KEYS, ["nombre_ouvertes"], "date_calcul")
    return t.spark.read.parquet(path).select(*_KEYS, "nombre_ouvertes", "nombre_cloturees")


@query("s17_bucketed_upsert", _UPSERT)
def bucketed_upsert(t):
    target, source = upsert_inputs(t)
    table = buckets.create(target, scratch.new_path(t.spark, "buckets"), _KEYS, 8)
    for _ in range(2):
        table.upsert(source, ["nombre_ouvertes"])
    return table.rows()


@query(
    "s18_insert_if_absent",
    """SELECT pdl_id, statut_pdl FROM points UNION ALL SELECT DISTINCT pdl_id, 'NOUVEAU' FROM complaint_points WHERE pdl_id NOT IN (SELECT pdl_id FROM points)""",
)
def insert_if_absent(t):
    target = t.points.select("pdl_id", "statut_pdl")
    source = t.complaint_points.select("pdl_id", F.lit("NOUVEAU").alias("statut_pdl"))
    return merge.insert_if_absent(target, source, ["pdl_id"])


def extracts(t):
    history = kpi_history(t)
    return sinks.reporting_extracts(history, consolidated(t), kpi.weekly_history(t.daily_kpi), RUN)


_EXTRACTS = """SELECT *, TRUE AS has_bytes, TRUE AS checksum_matches FROM (SELECT 'kpis_daily' AS extract, count(*) AS rows, 10 AS columns FROM kpi_history WHERE date_calcul >= DATE '2001-08-02' - 90
  UNION ALL SELECT 'reclamations_global', count(*), 16 FROM consolidated
  UNION ALL SELECT 'kpis_hebdomadaires', count(*), 12 FROM (SELECT DISTINCT date_trunc('week', date_calcul), region, type_reclamation FROM daily_kpi)
  UNION ALL SELECT 'sla_par_region', count(*), 6 FROM kpi_history WHERE date_calcul >= DATE '2001-08-02' - 365)"""


@query("s20_export_manifest", _EXTRACTS)
def export_manifest(t):
    """The manifest of the files; its checksums must be those of the frames that were written."""
    frames = extracts(t)
    paths = sinks.write_extracts(frames, scratch.new_path(t.spark, "extracts"))
    written = reduce(
        DataFrame.unionByName,
        [df.agg(sinks.fingerprint(df).alias("written")).withColumn("extract", F.lit(name)) for name, df in frames.items()],
    )
    return sinks.manifest(t.spark, paths).join(written, "extract").select(
        "extract",
        "rows",
        "columns",
        (F.col("bytes") > 0).alias("has_bytes"),
        F.col("checksum").eqNullSafe(F.col("written")).alias("checksum_matches"),
    )


@query(
    "s19_reporting_extract_kpis",
    """SELECT date_calcul::VARCHAR AS date_calcul, region, type_reclamation, nombre_ouvertes, nombre_cloturees, round(duree_moyenne_traitement, 4) AS duree_moyenne_traitement,
      round(duree_mediane_traitement, 4) AS duree_mediane_traitement, round(taux_respect_sla, 4) AS taux_respect_sla, nb_critiques, round(taux_escalade, 4) AS taux_escalade
    FROM kpi_history WHERE kpi_history.date_calcul >= DATE '2001-08-02' - 90""",
)
def reporting_extract_kpis(t):
    return extracts(t)["kpis_daily"]


@query(
    "s19_reporting_extract_complaints",
    """SELECT id_reclamation, client_id, region, departement, type_reclamation, statut, priorite, strftime(date_creation, '%Y-%m-%d %H:%M:%S') AS date_creation,
      strftime(date_cloture, '%Y-%m-%d %H:%M:%S') AS date_cloture, round(duree_heures, 4) AS duree_heures, sla_heures, sla_respect, risque_depassement,
      round(heures_restantes, 4) AS heures_restantes, source, export_date::VARCHAR AS export_date FROM consolidated
    WHERE consolidated.export_date >= DATE '2001-08-02' - 30""",
)
def reporting_extract_complaints(t):
    """All sixteen columns of the extract."""
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("date_creation", "date_cloture")}
    return extracts(t)["reclamations_global"].withColumns(times)


@query(
    "s19_reporting_extract_weeks",
    f"""WITH w AS (SELECT date_trunc('week', date_calcul)::DATE AS debut, region, type_reclamation, {_FIGURES} FROM daily_kpi GROUP BY 1, 2, 3)
    SELECT extract(isoyear FROM w.debut)::INTEGER AS annee, extract(week FROM w.debut)::INTEGER AS semaine, w.debut::VARCHAR AS debut_semaine,
      (w.debut + 6)::VARCHAR AS fin_semaine, w.region, w.type_reclamation, w.total_reclamations, w.total_ouvertes, w.total_cloturees, w.duree_moyenne_heures, w.taux_respect_sla,
      round((CASE WHEN p.total_reclamations > 0 THEN 100.0::DOUBLE * (w.total_reclamations - p.total_reclamations) / p.total_reclamations END)::DECIMAL(28,8), 2)::DOUBLE
        AS evolution_vs_semaine_precedente
    FROM w LEFT JOIN w p ON p.debut = w.debut - 7 AND p.region = w.region AND p.type_reclamation = w.type_reclamation""",
)
def reporting_extract_weeks(t):
    return extracts(t)["kpis_hebdomadaires"]


@query(
    "s19_reporting_extract_regions",
    """SELECT date_calcul::VARCHAR AS date_calcul, region, type_reclamation, round((avg(taux_respect_sla))::DECIMAL(28,8), 2)::DOUBLE AS taux_sla_moyen,
      sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS volume_total, round((avg(duree_moyenne_traitement))::DECIMAL(28,8), 2)::DOUBLE AS duree_moy
    FROM kpi_history WHERE date_calcul >= DATE '2001-08-02' - 365 GROUP BY 1, 2, 3""",
)
def reporting_extract_regions(t):
    return extracts(t)["sla_par_region"]


@query(
    "s21_output_validation",
    """SELECT 'complaints' AS nom_table, TRUE AS existe, count(*) AS nb, count(*) >= 100 AS valide FROM tickets
    UNION ALL SELECT 'points', TRUE, count(*), count(*) >= 1000000000 FROM points
    UNION ALL SELECT 'absente', FALSE, 0, FALSE""",
)
def output_validation(t):
    root = scratch.new_path(t.spark, "validated")
    sinks.write_parquet(t.complaints, f"{root}/complaints")
    sinks.write_parquet(t.points, f"{root}/points")
    paths = {n: f"{root}/{n}" for n in ("complaints", "points", "absente")}
    return sinks.validate_outputs(t.spark, paths, {"complaints": 100, "points": 1000000000})


@query(
    "s22_dated_archive",
    """SELECT CASE WHEN date_creation < DATE '2000-08-02' THEN 'archive' ELSE 'production' END AS lieu, count(*) AS nb FROM tickets GROUP BY 1""",
)
def dated_archive(t):
    root = scratch.new_path(t.spark, "archive")
    sinks.write_parquet(t.complaints, f"{root}/table")
    sinks.archive_table(t.spark, f"{root}/table", f"{root}/kept", f"{root}/old", "date_creation", RUN, 12)
    old = t.spark.read.parquet(f"{root}/old/{RUN}").select(F.lit("archive").alias("lieu"))
    kept = t.spark.read.parquet(f"{root}/kept").select(F.lit("production").alias("lieu"))
    return old.unionByName(kept).groupBy("lieu").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "s23_run_log",
    """SELECT dag_id, 'SUCCESS' AS status, rows_processed FROM (SELECT 'reclamations' AS dag_id, count(*) AS rows_processed FROM tickets
      UNION ALL SELECT 'compteurs', count(*) FROM meters)""",
)
def run_log(t):
    path = scratch.new_path(t.spark, "runs")
    for job, df in (("reclamations", t.complaints), ("compteurs", t.meters)):
        sinks.log_run(t.spark, path, job, "SUCCESS", df.count(), 1.5, AS_OF)
    return t.spark.read.parquet(path).select("dag_id", "status", "rows_processed")


@query("s24_target_columns", "SELECT id_reclamation, client_id FROM tickets")
def target_columns(t):
    target = t.complaint_points.select("id_reclamation", "client_id", "pdl_id")
    return merge.matching_columns(t.complaints, target)


@query("s25_empty_clone", "SELECT statut, count(*) AS nb FROM tickets GROUP BY 1")
def empty_clone(t):
    """Clone the structure, then fill the clone with the rows it lacks: all of them."""
    rows = t.complaints.select("id_reclamation", "client_id", "statut")
    filled = merge.insert_if_absent(merge.empty_like(rows), rows, ["id_reclamation"])
    return filled.groupBy("statut").agg(F.count(F.lit(1)).alias("nb"))


_FILLER = {"string": "INCONNU", "date": "2000-01-01", "timestamp": "2000-01-01 00:00:00", "boolean": False}


def shaped(df, table, **given):
    """``df`` in the declared columns of ``table``; a mandatory column it lacks gets a filler, an optional one is null."""
    columns = []
    for field in schemas.schema(table).fields:
        kind = field.dataType.simpleString()
        value = given.get(field.name, F.col(field.name) if field.name in df.columns else None)
        if value is None:
            value = F.lit(None if field.nullable else _FILLER.get(kind, 0))
        value = value.cast(field.dataType)
        columns.append((F.date_format(value, readers.TIMESTAMP_FORMAT) if kind == "timestamp" else value).alias(field.name))
    return df.select(*columns)


_INGESTED = {
    "reclamations": "tickets",
    "incidents": "incidents",
    "clients": "customer",
    "compteurs_linky": "meters",
    "historique_releves": "readings",
    "historique_interventions": "interventions",
    "factures": "lineitem",
    "meteo_quotidienne": "weather",
}


@query(
    "s26_multi_table_ingest",
    " UNION ALL ".join(
        f"SELECT '{n}' AS nom, TRUE AS charge, count(*) AS nb, {schemas.DDL[n].count(',') + 1} AS nb_colonnes, count(*) AS nb_complets FROM {v}"
        for n, v in _INGESTED.items()
    )
    + " UNION ALL SELECT 'postes_sources', FALSE, 0, 0, 0",
)
def multi_table_ingest(t):
    """All nine declared tables; the file of one is missing. The loaded ones are read back: columns and complete rows."""
    root = scratch.new_path(t.spark, "ingest")
    frames = {
        "reclamations": shaped(t.complaints, "reclamations"),
        "incidents": shaped(t.incidents, "incidents", latitude=F.coalesce("latitude", F.lit(0.0)), longitude=F.coalesce("longitude", F.lit(0.0))),
        "clients": shaped(t.raw("customer"), "clients", client_id=F.col("c_custkey"), nom=F.col("c_name"), type_client=F.col("c_mktsegment")),
        "compteurs_linky": shaped(t.meters, "compteurs_linky"),
        "historique_releves": shaped(t.readings, "historique_releves"),
        "historique_interventions": shaped(t.interventions, "historique_interventions"),
        "factures": shaped(t.invoices, "factures"),
        "meteo_quotidienne": shaped(t.weather, "meteo_quotidienne"),
    }
    for name, df in frames.items():
        sinks.write_csv(df, f"{root}/csv/{name}")
    done = sinks.ingest(
        t.spark, {n: f"{root}/csv/{n}" for n in schemas.DDL}, lambda table: schemas.layer_path(root, "bronze", table)
    )
    loaded = {r.table for r in done if r.error is None}
    states = t.spark.createDataFrame([(r.table, r.error is None, r.rows) for r in done], "nom string, charge boolean, nb bigint")
    complete = []
    for name in sorted(loaded):
        fields = schemas.schema(name).fields
        back = t.spark.read.parquet(schemas.layer_path(root, "bronze", name)).select(*[f.name for f in fields])
        mandatory = [f.name for f in fields if not f.nullable]
        complete.append(
            back.dropna(subset=mandatory).agg(F.count(F.lit(1)).alias("nb_complets")).select(
                F.lit(name).alias("nom"), F.lit(len(fields)).alias("nb_colonnes"), "nb_complets"
            )
        )
    return states.join(reduce(DataFrame.unionByName, complete), "nom", "left").fillna(0, ["nb_colonnes", "nb_complets"])


@query(
    "u06_file_concat",
    """SELECT count(*) AS nb, count(DISTINCT id_reclamation) AS nb_ids
    FROM (SELECT id_reclamation FROM tickets UNION ALL SELECT id_reclamation FROM tickets WHERE statut = 'CLOTURE')""",
)
def file_concat(t):
    """All complaints, then the closed ones again: the files overlap, so their ids come twice."""
    path = scratch.new_path(t.spark, "concat")
    rows = t.tickets.select("id_reclamation", "region", "statut")
    sinks.write_parquet(rows, path, ["region"])
    sinks.write_parquet(rows.filter(F.col("statut") == "CLOTURE"), path, ["region"], mode="append")
    return t.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("nb"), F.count_distinct("id_reclamation").alias("nb_ids")
    )


@query(
    "p21_serving_projection",
    """WITH d AS (SELECT *, date_diff('day', date_creation, coalesce(date_cloture, TIMESTAMP '2001-08-02')) * 24 AS dt,
      date_diff('day', date_creation, date_premiere_reponse) * 24 AS pr FROM tickets)
    SELECT '2001-08-02' AS date_calcul, region, type_reclamation, count(*) AS nombre_reclamations_total,
      count(*) FILTER (WHERE statut IN ('OUVERT', 'EN_COURS')) AS nombre_reclamations_ouvertes, count(*) FILTER (WHERE statut = 'CLOTURE') AS nombre_reclamations_cloturees,
      round(avg(dt), 4) AS duree_moyenne_traitement_heures, quantile_disc(dt, 0.5) AS duree_mediane_traitement_heures,
      round(avg(pr), 4) AS delai_moyen_premiere_reponse_heures, 0.00::DECIMAL(5,2) AS taux_respect_sla,
      0.00::DECIMAL(5,2) AS taux_reclamations_critiques, 0.00::DECIMAL(5,2) AS taux_escalade
    FROM d GROUP BY region, type_reclamation""",
)
def serving_projection(t):
    return sinks.serving_kpis(kpi.gold_daily(gold_enriched(t), AS_OF))


_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ["date_creation", "client_id", "type_reclamation", "priorite", "statut", "canal", "region",
                                                "date_premiere_reponse", "date_cloture", "reference_linky"])


@query(
    "layered_daily_kpis",
    f"""WITH u AS (SELECT * FROM raw_tickets WHERE client_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id_reclamation ORDER BY {_ORDER}) = 1),
    c AS (SELECT * FROM u WHERE coalesce(date_premiere_reponse >= date_creation, TRUE) AND coalesce(date_cloture >= date_creation, TRUE)),
    e AS (SELECT *, date_diff('day', date_creation, coalesce(date_cloture, TIMESTAMP '{AS_OF}')) * 24 AS dt, count(*) OVER (PARTITION BY client_id, type_reclamation) >= 2 AS rec FROM c)
    SELECT '2001-08-02' AS date_calcul, region, type_reclamation, count(*) AS nombre_reclamations_total, round(avg(dt), 4) AS duree_moyenne_traitement,
      count(*) FILTER (WHERE rec) AS nb_recurrentes FROM e GROUP BY region, type_reclamation""",
)
def layered_daily_kpis(t):
    """Raw → cleaned → enriched → daily KPIs through the written layers."""
    root = scratch.new_path(t.spark, "layers")
    sinks.write_parquet(raw_tickets(t), schemas.layer_path(root, "bronze", "reclamations"))
    layers.clean(t.spark, root)
    paths = layers.publish(t.spark, root, AS_OF)
    return t.spark.read.parquet(paths["kpis_daily"]).select(
        "date_calcul", "region", "type_reclamation", "nombre_reclamations_total", "duree_moyenne_traitement", "nb_recurrentes"
    )
