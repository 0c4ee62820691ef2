"""Declared schemas of the source tables (names and types are part of the data model)."""

from __future__ import annotations

from pyspark.sql import types as T

DDL = {
    "reclamations": """id_reclamation STRING NOT NULL, client_id STRING NOT NULL, type_reclamation STRING NOT NULL,
        description STRING, canal STRING, priorite STRING NOT NULL, statut STRING NOT NULL, region STRING NOT NULL,
        departement STRING, adresse STRING, code_postal STRING, latitude DOUBLE, longitude DOUBLE,
        reference_linky STRING, date_creation TIMESTAMP NOT NULL, date_premiere_reponse TIMESTAMP, date_cloture TIMESTAMP""",
    "incidents": """id_incident STRING NOT NULL, type_incident STRING NOT NULL, date_incident DATE NOT NULL,
        severite STRING NOT NULL, latitude DOUBLE NOT NULL, longitude DOUBLE NOT NULL, region STRING NOT NULL,
        clients_impactes INT""",
    "clients": """client_id STRING NOT NULL, nom STRING NOT NULL, type_client STRING NOT NULL, region STRING NOT NULL,
        date_inscription DATE NOT NULL, latitude DOUBLE, longitude DOUBLE""",
    "compteurs_linky": """reference_linky STRING NOT NULL, type_compteur STRING NOT NULL,
        puissance_souscrite_kva INT NOT NULL, region STRING NOT NULL, departement STRING NOT NULL, latitude DOUBLE,
        longitude DOUBLE, date_installation DATE NOT NULL, statut STRING NOT NULL, est_defectueux BOOLEAN NOT NULL,
        nombre_incidents INT NOT NULL""",
    "postes_sources": """id_poste STRING NOT NULL, nom_poste STRING NOT NULL, type_poste STRING NOT NULL,
        region STRING NOT NULL, departement STRING NOT NULL, latitude DOUBLE, longitude DOUBLE,
        capacite_mva INT NOT NULL, taux_charge_moyen DOUBLE, nombre_clients_desservis INT, statut STRING NOT NULL,
        date_mise_service DATE""",
    "historique_releves": """reference_linky STRING NOT NULL, date_releve DATE NOT NULL, index_hp INT, index_hc INT,
        consommation_kwh INT NOT NULL, type_releve STRING NOT NULL, anomalie_detectee BOOLEAN NOT NULL,
        type_anomalie STRING""",
    "historique_interventions": """id_intervention STRING NOT NULL, reference_linky STRING NOT NULL,
        type_intervention STRING NOT NULL, date_intervention STRING NOT NULL, technicien_id STRING NOT NULL,
        duree_minutes INT NOT NULL, statut STRING NOT NULL, resolu_premier_passage BOOLEAN,
        cout_intervention_euros DOUBLE, commentaire STRING""",
    "factures": """numero_facture STRING NOT NULL, reference_linky STRING NOT NULL, date_emission DATE NOT NULL,
        date_echeance DATE NOT NULL, consommation_kwh INT NOT NULL, montant_ht DOUBLE NOT NULL,
        montant_tva DOUBLE NOT NULL, montant_ttc DOUBLE NOT NULL, statut_paiement STRING NOT NULL, date_paiement DATE,
        est_contestee BOOLEAN NOT NULL, motif_contestation STRING""",
    "meteo_quotidienne": """date DATE NOT NULL, region STRING NOT NULL, temperature_min_celsius DOUBLE,
        temperature_max_celsius DOUBLE, condition_meteo STRING NOT NULL, precipitations_mm DOUBLE NOT NULL,
        vitesse_vent_kmh DOUBLE NOT NULL, evenement_extreme BOOLEAN NOT NULL, alerte_meteo BOOLEAN NOT NULL""",
}

RUN_LOG = """dag_id STRING, run_date DATE, status STRING, rows_processed BIGINT, duration_seconds DOUBLE,
    message STRING, created_at TIMESTAMP"""
QUALITY_METRICS = "table_name STRING, check_date DATE, metric_name STRING, metric_value DOUBLE, status STRING, message STRING"

LAYER_TABLES = {
    "bronze": list(DDL),
    "silver": ["reclamations_cleaned", "compteurs_verified", "factures_validated"],
    "gold": ["reclamations_enriched", "kpis_daily", "analytics_by_region"],
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])


def layer_path(root: str, layer: str, table: str) -> str:
    """Directory of a table in a layer; unknown layers are refused."""
    if layer not in LAYER_TABLES:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{table}"
