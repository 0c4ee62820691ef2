"""Complaint-domain views over star-schema Parquet tables.

``Tables`` gives lazy access to the raw tables and to derived domain frames
(complaints, readings, meters, invoices, …). Every frame is a plain projection or
aggregation of the given files, so work grows with them and Catalyst still prunes
columns and pushes filters down to the scans. ``SQL_VIEWS`` states the same rules
for the SQL cross-check.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice.functions import columns as C
from gridvoice.functions.domains import NOTICE_SLA, TYPES
from gridvoice.functions.skew import broadcast_if_small
from gridvoice.sources.scratch import materialise

# Schemas already read from file footers, by path: a second read of a table starts no job.
_SCHEMAS: dict[str, T.StructType] = {}

AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def pick(index: Column, values: list[str]) -> Column:
    """Element ``index`` (0-based) of a short literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def meter_reference(key: Column) -> Column:
    """``LKY`` and the key with at least eight digits; longer keys stay whole and so fail the format check."""
    return F.concat(F.lit("LKY"), C.zero_padded(key.cast("string"), 8))


def add_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), ts)


class Tables:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._kept: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        path = f"{self.directory}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def kept(self, name: str, build=None) -> DataFrame:
        """A derived frame (``build()``, or the attribute ``name``) written once per instance."""
        if name not in self._kept:
            self._kept[name] = materialise(build() if build else getattr(self, name), name)
        return self._kept[name]

    # ---- complaints from orders -------------------------------------------------

    @cached_property
    def complaints(self) -> DataFrame:
        """Complaints without geography: one scan of orders, no join."""
        k = F.col("o_orderkey")
        created = F.timestamp_add("MINUTE", ((k * 7) % 1440).cast("int"), F.col("o_orderdate").cast("timestamp"))
        urgent = F.col("o_orderpriority") == "1-URGENT"
        level = F.substring("o_orderpriority", 1, 1)
        return (
            self.raw("orders")
            .withColumn("_created", created)
            .select(
                k.alias("id_reclamation"),
                F.col("o_custkey").alias("client_id"),
                pick(k % 5, TYPES).alias("type_reclamation"),
                F.when(level == "1", "CRITIQUE")
                .when(level == "2", "HAUTE")
                .when(level == "3", "NORMALE")
                .when(level == "5", "BASSE")
                .otherwise("NON_PRECISEE")
                .alias("priorite"),
                F.when(F.col("o_orderstatus") == "F", "CLOTURE")
                .when(F.col("o_orderstatus") == "O", "OUVERT")
                .when(urgent, "ESCALADE")
                .otherwise("EN_COURS")
                .alias("statut"),
                F.when(k % 9 != 0, pick(k % 4, ["TELEPHONE", "EMAIL", "WEB", " AGENCE "])).alias("canal"),
                F.col("_created").alias("date_creation"),
                F.when(k % 4 != 0, add_hours(F.col("_created"), (k * 13) % 72)).alias("date_premiere_reponse"),
                F.when(
                    F.col("o_orderstatus") == "F",
                    add_hours(F.col("_created"), (k * 37) % 500 - 5 + F.when(k % 97 == 0, 5000).otherwise(0)),
                ).alias("date_cloture"),
                F.when(k % 10 != 0, (k % 100) / 10).alias("latitude"),
                F.when(k % 10 != 0, (k % 77) / 10).alias("longitude"),
                F.when(F.col("o_custkey") % 20 == 0, F.concat(F.lit("LK"), F.col("o_custkey").cast("string")))
                .otherwise(meter_reference(F.col("o_custkey")))
                .alias("reference_linky"),
                F.lpad((F.lit(75000) + (k * 31) % 20000).cast("string"), 5, "0").alias("code_postal"),
                F.col("o_totalprice").alias("montant"),
            )
        )

    @cached_property
    def geography(self) -> DataFrame:
        """Customer → region and département. Nation (25) and region (5) rows are fixed."""
        regions = broadcast_if_small(self.raw("region"))
        places = self.raw("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        return (
            self.raw("customer")
            .join(broadcast_if_small(places), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("departement"))
        )

    @cached_property
    def tickets(self) -> DataFrame:
        return self.complaints.join(
            self.geography, F.col("client_id") == F.col("c_custkey")
        ).drop("c_custkey")

    # ---- meters, invoices, interventions ---------------------------------------

    @cached_property
    def meters(self) -> DataFrame:
        k = F.col("c_custkey")
        power = F.element_at(F.array(*[F.lit(p) for p in (3, 6, 9, 12, 15, 18, 24, 36, 7)]), (k % 9 + 1).cast("int"))
        return (
            self.raw("customer")
            .join(self.geography.withColumnRenamed("c_custkey", "_g"), k == F.col("_g"))
            .select(
                k.alias("client_id"),
                F.when(k % 20 == 0, F.concat(F.lit("LK"), k.cast("string")))
                .otherwise(meter_reference(k))
                .alias("reference_linky"),
                F.when(k % 3 == 0, "TRIPHASE").otherwise("MONOPHASE").alias("type_compteur"),
                power.alias("puissance_souscrite_kva"),
                "region",
                "departement",
                F.date_add(F.lit("1990-01-01").cast("date"), (k % 1500).cast("int")).alias("date_installation"),
                (k % 13 == 0).alias("est_defectueux"),
                (k % 4).cast("int").alias("nombre_incidents"),
            )
        )

    @cached_property
    def invoices(self) -> DataFrame:
        ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
        vat = F.col("l_extendedprice") * F.col("l_tax")
        issued = F.to_date("l_shipdate")
        return self.raw("lineitem").select(
            F.concat_ws("-", ok.cast("string"), ln.cast("string")).alias("numero_facture"),
            meter_reference(F.col("l_partkey")).alias("reference_linky"),
            issued.alias("date_emission"),
            F.date_add(issued, F.when(ok % 200 == 0, -1).otherwise(30)).alias("date_echeance"),
            F.col("l_extendedprice").alias("montant_ht"),
            vat.alias("montant_tva"),
            (F.col("l_extendedprice") + vat + F.when((ok + ln) % 50 == 0, 1.0).otherwise(0.0)).alias("montant_ttc"),
            (F.col("l_returnflag") == "R").alias("est_contestee"),
            F.when(F.col("l_returnflag") == "R", pick(ln % 2, ["ERREUR_INDEX", "DOUBLE_FACTURE"])).alias(
                "motif_contestation"
            ),
        )

    @cached_property
    def interventions(self) -> DataFrame:
        ln = F.col("l_linenumber")
        return self.raw("lineitem").select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), ln.cast("string")).alias("id_intervention"),
            F.col("l_orderkey").alias("id_reclamation"),
            F.col("l_suppkey").alias("technicien_id"),
            F.col("l_returnflag").alias("zone_intervention"),
            (F.col("l_suppkey") % 25).alias("departement"),
            F.least(ln, F.lit(5)).alias("priorite"),
            F.when(F.col("l_linestatus") == "O", "PLANIFIEE").otherwise("REALISEE").alias("statut"),
            F.to_date("l_shipdate").alias("date_planifiee"),
            F.when(ln != 7, F.col("l_quantity") / 10).alias("duree_estimee_h"),
        )

    # ---- event-era frames ------------------------------------------------------

    @cached_property
    def _events(self) -> DataFrame:
        regions = self.raw("region").select(F.col("r_regionkey").alias("_rk"), F.col("r_name").alias("region"))
        return (
            self.raw("events")
            .withColumn("ts", F.col("ts").cast("timestamp"))
            .join(broadcast_if_small(regions), F.col("user_id") % 5 == F.col("_rk"))
            .withColumn("_kind", self.event_complaint_type())
        )

    @staticmethod
    def event_complaint_type() -> Column:
        kinds = ["click", "error", "purchase", "signup"]
        out = F
        for event, complaint in zip(kinds, TYPES):
            out = out.when(F.col("event_type") == event, complaint)
        return out.otherwise(TYPES[4])

    @cached_property
    def event_tickets(self) -> DataFrame:
        k = F.col("event_id")
        status = pick(k % 4, ["CLOTURE", "OUVERT", "EN_COURS", "OUVERT"])
        return self._events.select(
            k.alias("id_reclamation"),
            F.col("user_id").alias("client_id"),
            F.col("_kind").alias("type_reclamation"),
            pick(k % 4, ["CRITIQUE", "HAUTE", "NORMALE", "BASSE"]).alias("priorite"),
            status.alias("statut"),
            "region",
            F.concat(F.lit("D"), (F.col("user_id") % 5).cast("string")).alias("departement"),
            F.col("ts").alias("date_creation"),
        )

    @cached_property
    def readings(self) -> DataFrame:
        k, u = F.col("event_id"), F.col("user_id")
        return self.raw("events").select(
            meter_reference(u * 10 + k % 10).alias("reference_linky"),
            u.alias("numero_compteur"),
            (u % 5).alias("zone"),
            F.date_add(F.lit("1995-01-01").cast("date"), ((k * 7) % 2404).cast("int")).alias("date_releve"),
            F.col("value").alias("consommation_kwh"),
            (F.col("event_type") == "error").alias("anomalie_detectee"),
        )

    @cached_property
    def linky_detail(self) -> DataFrame:
        k = F.col("event_id")
        return self._events.select(
            k.alias("id_reclamation"),
            F.when(k % 50 != 49, F.col("user_id")).alias("numero_compteur"),
            F.when(F.col("value") < 5, 0.0).otherwise(F.col("value")).alias("consommation_kwh"),
            F.when(k % 10 != 9, (k % 61 - 30).cast("double")).alias("ecart_index_pct"),
            F.to_date("ts").alias("export_date"),
            F.col("event_type").alias("type_panne"),
            "region",
            F.col("value").alias("duree_heures"),
        )

    @cached_property
    def incidents(self) -> DataFrame:
        k = F.col("event_id")
        day = F.date_add(F.lit("1995-01-01").cast("date"), ((k * 7) % 2404).cast("int"))
        return self._events.filter(F.col("event_type") == "error").select(
            k.alias("id_incident"),
            day.alias("date_incident"),
            F.when(k % 10 != 0, F.date_add(day, 2)).alias("date_fin"),
            "region",
            ((k % 100) / 10).alias("latitude"),
            ((k % 77) / 10).alias("longitude"),
            (k % 900).cast("int").alias("clients_impactes"),
        )

    @cached_property
    def daily_kpi(self) -> DataFrame:
        k = F.col("event_id")
        total = F.count(F.lit(1))
        return (
            self._events.groupBy(F.to_date("ts").alias("date_calcul"), "region", F.col("_kind").alias("type_reclamation"))
            .agg(
                total.alias("nombre_reclamations_total"),
                F.count_if(k % 3 != 0).alias("nombre_ouvertes"),
                F.count_if(k % 3 == 0).alias("nombre_cloturees"),
                F.avg("value").alias("duree_moyenne_traitement"),
                F.percentile_approx("value", 0.5).alias("duree_mediane_traitement"),
                F.count_if(k % 7 == 0).alias("nb_critiques"),
                (F.count_if(F.col("value") <= 60) * 100.0 / total).alias("taux_respect_sla"),
                (F.count_if(k % 11 == 0) * 100.0 / total).alias("taux_escalade"),
            )
        )

    @cached_property
    def weather(self) -> DataFrame:
        dept = F.col("user_id") % 25
        gust = F.max("value") / 12
        return (
            self._events.groupBy(F.to_date("ts").alias("date_mesure"), "region", dept.alias("departement"))
            .agg(
                gust.alias("vent_rafales_ms"),
                (gust * 0.8).alias("vent_max_ms"),
                (F.avg("value") / 10).alias("precipitation_mm"),
                F.lit(0.0).alias("neige_cm"),
                (F.min("value") - 6).alias("temperature_min_c"),
                (F.max("value") / 12 + 5).alias("temperature_max_c"),
            )
            .withColumn("vigilance_meteo", F.when(F.col("departement") == 3, "JAUNE").otherwise("VERTE"))
            .withColumn("type_phenomene", F.when(F.col("departement") == 3, "ORAGE").otherwise("AUCUN"))
        )

    @cached_property
    def notifications(self) -> DataFrame:
        k = F.col("event_id")
        return self.raw("events").select(
            k.alias("id"),
            k.alias("id_reclamation"),
            F.col("user_id").alias("client_id"),
            pick((k * 3) % 5, list(NOTICE_SLA)).alias("type_notification"),
            F.col("ts").cast("timestamp").alias("date_envoi"),
            F.when(k % 6 == 0, "ECHEC").otherwise("ENVOYE").alias("statut"),
            F.when(k % 4 == 0, False).when(k % 9 == 0, F.lit(None).cast("boolean")).otherwise(True).alias("dans_delai_legal"),
            F.col("ts").cast("timestamp").alias("created_at"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        k = F.col("event_id")
        return self.raw("events").select(
            F.col("event_type").alias("dag_id"),
            F.when(k % 10 == 0, "FAILED").when(k % 10 == 1, "WARNING").otherwise("SUCCESS").alias("status"),
            k.alias("rows_processed"),
            F.col("value").alias("duration_seconds"),
            F.col("ts").cast("timestamp").alias("created_at"),
        )

    # ---- customer-derived frames ----------------------------------------------

    @cached_property
    def requests(self) -> DataFrame:
        k = F.col("c_custkey")
        asked = F.date_add(F.lit("2001-06-01").cast("date"), (k % 60).cast("int"))
        kinds = ["OUBLI", "ACCES", "RECTIFICATION", "PORTABILITE"]
        return self.raw("customer").select(
            k.alias("id"),
            k.alias("client_id"),
            F.when(k % 50 < 4, pick(F.least(k % 50, F.lit(3)), kinds)).otherwise("OPPOSITION").alias("type_demande"),
            asked.alias("date_demande"),
            F.date_add(asked, 30).alias("date_limite_legal"),
            pick(F.floor(k / 50) % 4, ["EN_ATTENTE", "EN_COURS", "TRAITE", "EN_ATTENTE"]).alias("statut"),
        )

    @staticmethod
    def _pdl(k: Column) -> Column:
        """Some customers share the point of their neighbour."""
        return F.when(k % 15 == 14, k - 1).otherwise(k)

    @cached_property
    def point_history(self) -> DataFrame:
        k = F.col("c_custkey")
        start = F.date_add(F.lit("1994-01-01").cast("date"), (k % 1000).cast("int"))
        current = k % 4 != 3
        return self.raw("customer").select(
            self._pdl(k).alias("pdl_id"),
            k.alias("client_id"),
            start.alias("date_debut"),
            F.when(~current, F.date_add(start, 900)).alias("date_fin"),
            current.alias("is_current"),
        )

    @cached_property
    def points(self) -> DataFrame:
        """Reference list of delivery points; those of customers in debt are missing."""
        k = F.col("c_custkey")
        return (
            self.raw("customer")
            .filter((F.col("c_acctbal") >= 0) & (self._pdl(k) == k))
            .select(
                k.alias("pdl_id"),
                F.when(k % 8 == 0, "INACTIF").otherwise("ACTIF").alias("statut_pdl"),
                (k % 25).alias("departement"),
                F.lit("1995-01-01").cast("date").alias("date_derniere_maj"),
            )
        )

    @cached_property
    def complaint_points(self) -> DataFrame:
        return self.complaints.select(
            "id_reclamation", self._pdl(F.col("client_id")).alias("pdl_id"), "client_id", "date_creation"
        )


_TYPE_CASE = "CASE {0} WHEN 0 THEN 'COUPURE_ELECTRIQUE' WHEN 1 THEN 'COMPTEUR_LINKY' WHEN 2 THEN 'FACTURATION' WHEN 3 THEN 'RACCORDEMENT_RESEAU' ELSE 'INTERVENTION_TECHNIQUE' END"

# name → (views it reads, SQL body)
SQL_VIEWS: dict[str, str] = {
    "tickets": f"""
      SELECT o_orderkey AS id_reclamation, o_custkey AS client_id,
        {_TYPE_CASE.format("o_orderkey % 5")} AS type_reclamation,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'CRITIQUE' WHEN '2' THEN 'HAUTE' WHEN '3' THEN 'NORMALE'
          WHEN '5' THEN 'BASSE' ELSE 'NON_PRECISEE' END AS priorite,
        CASE WHEN o_orderstatus = 'F' THEN 'CLOTURE' WHEN o_orderstatus = 'O' THEN 'OUVERT'
          WHEN o_orderpriority = '1-URGENT' THEN 'ESCALADE' ELSE 'EN_COURS' END AS statut,
        CASE WHEN o_orderkey % 9 <> 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'TELEPHONE' WHEN 1 THEN 'EMAIL'
          WHEN 2 THEN 'WEB' ELSE ' AGENCE ' END END AS canal,
        CAST(o_orderdate AS TIMESTAMP) + to_minutes((o_orderkey * 7) % 1440) AS date_creation,
        CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + to_minutes((o_orderkey * 7) % 1440)
          + to_hours((o_orderkey * 13) % 72) END AS date_premiere_reponse,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + to_minutes((o_orderkey * 7) % 1440)
          + to_hours((o_orderkey * 37) % 500 - 5 + CASE WHEN o_orderkey % 97 = 0 THEN 5000 ELSE 0 END) END AS date_cloture,
        CASE WHEN o_orderkey % 10 <> 0 THEN (o_orderkey % 100) / 10.0::DOUBLE END AS latitude,
        CASE WHEN o_orderkey % 10 <> 0 THEN (o_orderkey % 77) / 10.0::DOUBLE END AS longitude,
        CASE WHEN o_custkey % 20 = 0 THEN 'LK' || o_custkey ELSE 'LKY' || lpad(o_custkey::VARCHAR, greatest(8, length(o_custkey::VARCHAR))::INTEGER, '0') END AS reference_linky,
        lpad((75000 + (o_orderkey * 31) % 20000)::VARCHAR, 5, '0') AS code_postal,
        o_totalprice AS montant, r_name AS region, n_name AS departement
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "meters": """
      SELECT c_custkey AS client_id,
        CASE WHEN c_custkey % 20 = 0 THEN 'LK' || c_custkey ELSE 'LKY' || lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INTEGER, '0') END AS reference_linky,
        CASE WHEN c_custkey % 3 = 0 THEN 'TRIPHASE' ELSE 'MONOPHASE' END AS type_compteur,
        [3, 6, 9, 12, 15, 18, 24, 36, 7][c_custkey % 9 + 1] AS puissance_souscrite_kva,
        r_name AS region, n_name AS departement,
        DATE '1990-01-01' + (c_custkey % 1500)::INTEGER AS date_installation,
        c_custkey % 13 = 0 AS est_defectueux, (c_custkey % 4)::INTEGER AS nombre_incidents
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "invoices": """
      SELECT l_orderkey || '-' || l_linenumber AS numero_facture,
        'LKY' || lpad(l_partkey::VARCHAR, greatest(8, length(l_partkey::VARCHAR))::INTEGER, '0') AS reference_linky,
        CAST(l_shipdate AS DATE) AS date_emission,
        CAST(l_shipdate AS DATE) + CASE WHEN l_orderkey % 200 = 0 THEN -1 ELSE 30 END AS date_echeance,
        l_extendedprice AS montant_ht, l_extendedprice * l_tax AS montant_tva,
        l_extendedprice + l_extendedprice * l_tax
          + CASE WHEN (l_orderkey + l_linenumber) % 50 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS montant_ttc,
        l_returnflag = 'R' AS est_contestee,
        CASE WHEN l_returnflag = 'R' THEN CASE l_linenumber % 2 WHEN 0 THEN 'ERREUR_INDEX' ELSE 'DOUBLE_FACTURE' END END AS motif_contestation
      FROM lineitem""",
    "interventions": """
      SELECT l_orderkey || '-' || l_linenumber AS id_intervention, l_orderkey AS id_reclamation,
        l_suppkey AS technicien_id, l_returnflag AS zone_intervention, l_suppkey % 25 AS departement,
        least(l_linenumber, 5) AS priorite,
        CASE WHEN l_linestatus = 'O' THEN 'PLANIFIEE' ELSE 'REALISEE' END AS statut,
        CAST(l_shipdate AS DATE) AS date_planifiee,
        CASE WHEN l_linenumber <> 7 THEN l_quantity / 10 END AS duree_estimee_h
      FROM lineitem""",
    "event_rows": """
      SELECT event_id, ts, user_id, event_type, value, r_name AS region,
        CASE event_type WHEN 'click' THEN 'COUPURE_ELECTRIQUE' WHEN 'error' THEN 'COMPTEUR_LINKY'
          WHEN 'purchase' THEN 'FACTURATION' WHEN 'signup' THEN 'RACCORDEMENT_RESEAU'
          ELSE 'INTERVENTION_TECHNIQUE' END AS kind
      FROM events JOIN region ON user_id % 5 = r_regionkey""",
    "event_tickets": """
      SELECT event_id AS id_reclamation, user_id AS client_id, kind AS type_reclamation,
        CASE event_id % 4 WHEN 0 THEN 'CRITIQUE' WHEN 1 THEN 'HAUTE' WHEN 2 THEN 'NORMALE' ELSE 'BASSE' END AS priorite,
        CASE event_id % 4 WHEN 0 THEN 'CLOTURE' WHEN 2 THEN 'EN_COURS' ELSE 'OUVERT' END AS statut,
        region, 'D' || (user_id % 5) AS departement, ts AS date_creation
      FROM event_rows""",
    "readings": """
      SELECT 'LKY' || lpad((user_id * 10 + event_id % 10)::VARCHAR, greatest(8, length((user_id * 10 + event_id % 10)::VARCHAR))::INTEGER, '0') AS reference_linky,
        user_id AS numero_compteur, user_id % 5 AS zone,
        DATE '1995-01-01' + ((event_id * 7) % 2404)::INTEGER AS date_releve,
        value AS consommation_kwh, event_type = 'error' AS anomalie_detectee
      FROM events""",
    "linky_detail": """
      SELECT event_id AS id_reclamation, CASE WHEN event_id % 50 <> 49 THEN user_id END AS numero_compteur,
        CASE WHEN value < 5 THEN 0.0::DOUBLE ELSE value END AS consommation_kwh,
        CASE WHEN event_id % 10 <> 9 THEN (event_id % 61 - 30)::DOUBLE END AS ecart_index_pct,
        CAST(ts AS DATE) AS export_date, event_type AS type_panne, region, value AS duree_heures
      FROM event_rows""",
    "incidents": """
      SELECT event_id AS id_incident, DATE '1995-01-01' + ((event_id * 7) % 2404)::INTEGER AS date_incident,
        CASE WHEN event_id % 10 <> 0 THEN DATE '1995-01-01' + ((event_id * 7) % 2404)::INTEGER + 2 END AS date_fin,
        region, (event_id % 100) / 10.0::DOUBLE AS latitude, (event_id % 77) / 10.0::DOUBLE AS longitude,
        (event_id % 900)::INTEGER AS clients_impactes
      FROM event_rows WHERE event_type = 'error'""",
    "daily_kpi": """
      SELECT CAST(ts AS DATE) AS date_calcul, region, kind AS type_reclamation,
        count(*) AS nombre_reclamations_total,
        count(*) FILTER (WHERE event_id % 3 <> 0) AS nombre_ouvertes,
        count(*) FILTER (WHERE event_id % 3 = 0) AS nombre_cloturees,
        avg(value) AS duree_moyenne_traitement, quantile_disc(value, 0.5) AS duree_mediane_traitement,
        count(*) FILTER (WHERE event_id % 7 = 0) AS nb_critiques,
        count(*) FILTER (WHERE value <= 60) * 100.0::DOUBLE / count(*) AS taux_respect_sla,
        count(*) FILTER (WHERE event_id % 11 = 0) * 100.0::DOUBLE / count(*) AS taux_escalade
      FROM event_rows GROUP BY 1, 2, 3""",
    "weather": """
      SELECT CAST(ts AS DATE) AS date_mesure, region, user_id % 25 AS departement,
        max(value) / 12 AS vent_rafales_ms, max(value) / 12 * 0.8::DOUBLE AS vent_max_ms,
        avg(value) / 10 AS precipitation_mm, 0.0::DOUBLE AS neige_cm,
        min(value) - 6 AS temperature_min_c, max(value) / 12 + 5 AS temperature_max_c,
        CASE WHEN user_id % 25 = 3 THEN 'JAUNE' ELSE 'VERTE' END AS vigilance_meteo,
        CASE WHEN user_id % 25 = 3 THEN 'ORAGE' ELSE 'AUCUN' END AS type_phenomene
      FROM event_rows GROUP BY CAST(ts AS DATE), region, user_id % 25""",
    "notifications": """
      SELECT event_id AS id, event_id AS id_reclamation, user_id AS client_id,
        ['ACCUSE_RECEPTION', 'COUPURE_PROGRAMMEE', 'RESOLUTION_RECLAMATION', 'INCIDENT_SYSTEMIQUE',
         'DEPASSEMENT_SLA'][(event_id * 3) % 5 + 1] AS type_notification,
        ts AS date_envoi, CASE WHEN event_id % 6 = 0 THEN 'ECHEC' ELSE 'ENVOYE' END AS statut,
        CASE WHEN event_id % 4 = 0 THEN FALSE WHEN event_id % 9 = 0 THEN NULL ELSE TRUE END AS dans_delai_legal,
        ts AS created_at
      FROM events""",
    "runs": """
      SELECT event_type AS dag_id, CASE event_id % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'WARNING' ELSE 'SUCCESS' END AS status,
        event_id AS rows_processed, value AS duration_seconds, ts AS created_at
      FROM events""",
    "requests": """
      SELECT c_custkey AS id, c_custkey AS client_id,
        CASE c_custkey % 50 WHEN 0 THEN 'OUBLI' WHEN 1 THEN 'ACCES' WHEN 2 THEN 'RECTIFICATION' WHEN 3 THEN 'PORTABILITE' ELSE 'OPPOSITION' END AS type_demande,
        DATE '2001-06-01' + (c_custkey % 60)::INTEGER AS date_demande,
        DATE '2001-06-01' + (c_custkey % 60)::INTEGER + 30 AS date_limite_legal,
        CASE (c_custkey // 50) % 4 WHEN 1 THEN 'EN_COURS' WHEN 2 THEN 'TRAITE' ELSE 'EN_ATTENTE' END AS statut
      FROM customer""",
    "point_history": """
      SELECT CASE WHEN c_custkey % 15 = 14 THEN c_custkey - 1 ELSE c_custkey END AS pdl_id, c_custkey AS client_id,
        DATE '1994-01-01' + (c_custkey % 1000)::INTEGER AS date_debut,
        CASE WHEN c_custkey % 4 = 3 THEN DATE '1994-01-01' + (c_custkey % 1000)::INTEGER + 900 END AS date_fin,
        c_custkey % 4 <> 3 AS is_current
      FROM customer""",
    "points": """
      SELECT c_custkey AS pdl_id,
        CASE WHEN c_custkey % 8 = 0 THEN 'INACTIF' ELSE 'ACTIF' END AS statut_pdl, c_custkey % 25 AS departement,
        DATE '1995-01-01' AS date_derniere_maj
      FROM customer WHERE c_acctbal >= 0 AND c_custkey % 15 <> 14""",
    "complaint_points": """
      SELECT id_reclamation, CASE WHEN client_id % 15 = 14 THEN client_id - 1 ELSE client_id END AS pdl_id, client_id, date_creation
      FROM tickets""",
}


def register_sql_view(name: str, body: str) -> None:
    SQL_VIEWS[name] = body


def with_views(sql: str) -> str:
    """Prefix a query with the domain views it mentions, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({SQL_VIEWS[name]})" for name in needed)
    sql = sql.strip()
    if sql[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"
