"""Business rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.operators import (
    anomaly,
    clusters,
    cleaning,
    consolidate,
    enrich,
    fraud,
    kpi,
    monitoring,
    privacy,
    quality,
    regulatory,
    sla,
    weather,
)


def stamped(spark, rows, ddl, *times):
    df = spark.createDataFrame(rows, ddl)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times})


def one(df):
    return [tuple(r) for r in df.collect()]


def test_priority_score_default_and_adjustments(spark):
    rows = [("CRITIQUE", "OUVERT", 30.0), ("HAUTE", "CLOTURE", None), ("INCONNUE", "EN_COURS", 24.0), (None, "ESCALADE", 25.0), ("BASSE", "OUVERT", 1.0)]
    df = spark.createDataFrame(rows, "priorite string, statut string, delai_premiere_reponse_heures double")
    assert [r.score_priorite for r in enrich.with_priority_score(df).collect()] == [110, 75, 70, 40, 45]


def test_durations_exact_and_in_days(spark):
    df = stamped(
        spark,
        [("2024-01-01 23:00:00", "2024-01-02 01:30:00", None), ("2024-01-01 10:00:00", None, "2024-01-01 11:00:00")],
        "date_creation string, date_cloture string, date_premiere_reponse string",
        "date_creation",
        "date_cloture",
        "date_premiere_reponse",
    )
    exact = enrich.with_durations(df).select("duree_traitement_heures", "delai_premiere_reponse_heures")
    assert one(exact) == [(2.5, None), (None, 1.0)]
    days = enrich.with_day_durations(df, "2024-01-04 00:00:00").select("duree_traitement_heures", "delai_premiere_reponse_heures")
    assert one(days) == [(24, None), (72, 0)]
    assert one(enrich.with_elapsed(df, "2024-01-01 12:00:00").select("duree_heures")) == [(2.5,), (2.0,)]


def test_reference_normalisation_and_repair(spark):
    df = spark.createDataFrame([("12345",), ("LINKY-67890",), (None,), ("LINKY_7",)], "ref string")
    got = df.select(enrich.normalise_meter_reference("ref"), enrich.repair_meter_reference("ref"))
    assert one(got) == [("LINKY_12345", "12345"), ("LINKY_67890", "67890"), (None, None), ("LINKY_00007", "7")]


def test_weighted_priority_formula(spark):
    df = stamped(spark, [("CRITIQUE", True, True, "2024-01-01")], "priorite string, est_recurrent boolean, est_lie_incident boolean, date_creation string", "date_creation")
    assert one(enrich.weighted_priority(df, "2024-01-06 00:00:00").select("score_pondere")) == [(56.0,)]


def test_text_category_reads_the_whole_text(spark):
    text = "x" * 200_000 + " le Compteur"
    df = spark.createDataFrame([(text, "A"), ("Facture fausse", "A"), ("rien", "AUTRE")], "t string, d string")
    assert [r[0] for r in df.select(enrich.text_category("t", "d")).collect()] == ["COMPTEUR_LINKY", "FACTURATION", "AUTRE"]


def test_open_complaint_past_limit_is_a_breach(spark):
    df = stamped(
        spark,
        [(1, "COUPURE_ELECTRIQUE", "OUVERT", "2024-01-01", None), (2, "COUPURE_ELECTRIQUE", "CLOTURE", "2024-01-01", "2024-01-09"), (3, "AUTRE", "ESCALADE", "2024-01-01", None)],
        "id int, type_reclamation string, statut string, date_creation string, date_cloture string",
        "date_creation",
        "date_cloture",
    )
    timed = sla.with_limit(enrich.with_elapsed(df, "2024-01-04 00:00:00"))
    assert [(r.id, r.depassement_heures) for r in sla.breaches(timed).collect()] == [(1, 24.0)]
    assert [r.sla_heures for r in timed.orderBy("id").collect()] == [48, 48, 168]


@pytest.mark.parametrize("left,risk", [(0.0, True), (11.9, True), (12.0, False), (-0.1, False)])
def test_breach_risk_bounds(spark, left, risk):
    df = spark.createDataFrame([("OUVERT", left)], "statut string, heures_restantes double")
    assert sla.with_breach_risk(df, 12).first().risque_depassement is risk
    closed = spark.createDataFrame([("CLOTURE", None)], "statut string, heures_restantes double")
    assert sla.with_breach_risk(closed, 12).first().risque_depassement is False


def test_alert_levels_in_order(spark):
    rows = [(True, 60.0, 48, 1.0), (False, 60.0, 48, -12.0), (False, 40.0, 48, 8.0), (False, 1.0, 48, 47.0)]
    df = spark.createDataFrame(rows, "risque_depassement boolean, duree_heures double, sla_heures int, heures_restantes double")
    assert [r[0] for r in df.select(sla.alert_level()).collect()] == ["RISQUE_IMMINENT", "HORS_SLA", "EN_VIGILANCE", "NOMINAL"]


def test_override_takes_detail_nulls(spark):
    base = spark.createDataFrame([(1, True, "base"), (2, False, "base")], "id int, sla_respect boolean, source string")
    detail = spark.createDataFrame([(1, None)], "id int, sla_respect boolean")
    got = consolidate.override(base, detail, ["id"], ["sla_respect"], source="detail").orderBy("id")
    assert one(got) == [(1, None, "detail"), (2, False, "base")]


def test_quality_counts_null_ids_once_and_empty_input(spark):
    ddl = "id_reclamation int, client_id int, type_reclamation string, statut string, priorite string, region string, date_creation timestamp, date_cloture timestamp"
    df = spark.createDataFrame([(None, 1, "FACTURATION", "OUVERT", "HAUTE", "A", None, None)] * 3 + [(1, None, "X", None, "HAUTE", "A", None, None)], ddl)
    row = quality.overall(df).first()
    assert (row.total, row.duplicates, row.unicite) == (4, 2, 50.0)
    assert row.validite == pytest.approx(round((1 - 2 / 12) * 100, 2))
    assert row.completude == pytest.approx(round((1 - 9 / 28) * 100, 2))
    assert quality.completeness(df.limit(0)).first().score == 100.0


def test_completeness_of_one_column(spark):
    df = spark.createDataFrame([("R1", "C1"), ("R2", None)], "id string, client_id string")
    assert quality.completeness(df, ["client_id"]).first().score == 50.0


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None), (None, "b")], "v double, t string")
    assert {r.colonne: r.nb_nulls for r in quality.null_profile(df).collect()} == {"v": 2, "t": 1}


def test_gate_stops_the_job(spark):
    scores = spark.createDataFrame([(89.9,)], "score double")
    assert quality.enforce(scores, "score", 80.0) == 89.9
    with pytest.raises(quality.QualityError):
        quality.enforce(scores, "score", 90.0)


def test_cleaner_is_idempotent_and_rejects(spark):
    rows = [
        (1, 1, " FACTURATION ", "HAUTE", "OUVERT", "WEB", "A", "2024-01-01", None, None, "LKY00000001"),
        (1, 1, " FACTURATION ", "HAUTE", "OUVERT", "WEB", "A", "2024-01-02", None, None, "BAD"),
        (2, None, "FACTURATION", "HAUTE", "OUVERT", "WEB", "A", "2024-01-01", None, None, None),
        (3, 1, "FACTURATION", "HAUTE", "CLOTURE", "WEB", "A", "2024-01-05", None, "2024-01-04", None),
    ]
    df = stamped(
        spark,
        rows,
        "id_reclamation int, client_id int, type_reclamation string, priorite string, statut string, canal string, region string, date_creation string, date_premiere_reponse string, date_cloture string, reference_linky string",
        "date_creation",
        "date_premiere_reponse",
        "date_cloture",
    )
    clean = cleaning.clean_complaints(df)
    assert [(r.id_reclamation, r.type_reclamation, r.reference_linky) for r in clean.collect()] == [(1, "FACTURATION", "LKY00000001")]
    assert one(cleaning.clean_complaints(clean)) == one(clean)


def test_amount_tolerance_has_no_float_edge(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.31), (0.1, 0.2, 0.3), (0.1, 0.2, 0.32)], "montant_ht double, montant_tva double, montant_ttc double")
    assert [r[0] for r in df.select(cleaning.amounts_agree()).collect()] == [True, True, False]


def test_z_score_without_deviation_is_null(spark):
    df = stamped(spark, [("A", "2024-01-01"), ("A", "2024-01-02")], "region string, date_creation string", "date_creation")
    scored = anomaly.with_z_score(anomaly.with_mean_and_deviation(anomaly.daily_counts(df)))
    assert {r.z_score for r in scored.collect()} == {None}
    assert anomaly.volume_outliers(df).count() == 0


def test_cluster_window_is_the_even_hour(spark):
    rows = [(i, i, "A", None, "COUPURE_ELECTRIQUE", "OUVERT", f"2024-01-01 03:{i:02d}:00") for i in range(12)]
    df = stamped(spark, rows, "id_reclamation int, client_id int, region string, departement string, type_reclamation string, statut string, date_creation string", "date_creation")
    found = clusters.clusters(clusters.open_outages(df)).collect()
    assert [(str(r.fenetre_debut), r.departement, r.nb_clients) for r in found] == [("2024-01-01 02:00:00", "INCONNU", 12)]
    key = clusters.clusters(clusters.open_outages(df)).select(clusters.incident_key()).first()[0]
    assert key == "INC-INCONNU-2024010102-0012"


@pytest.mark.parametrize("n,label", [(9, "MINEUR"), (30, "MODERE"), (100, "MAJEUR"), (500, "CRITIQUE")])
def test_cluster_severity(spark, n, label):
    assert spark.range(1).select(clusters.severity(F.lit(n))).first()[0] == label


def test_incident_merge_raises_counts_and_links(spark):
    found = stamped(
        spark,
        [("A", "75", "2024-01-01 02:00:00", 40, 45, "2024-01-01 02:10:00", "2024-01-01 03:00:00"), ("A", "76", "2024-01-01 02:00:00", 12, 12, "2024-01-01 02:10:00", "2024-01-01 03:00:00")],
        "region string, departement string, fenetre_debut string, nb_clients bigint, nb_reclamations bigint, debut_incident string, fin_periode string",
        "fenetre_debut", "debut_incident", "fin_periode",
    )
    known = stamped(
        spark,
        [("K1", "2024-01-01 01:00:00", "2024-01-01 01:10:00", "A", "75", "MINEUR", 5, 99, "EN_COURS"), ("K2", "2024-01-01 01:00:00", "2024-01-01 01:09:59", "A", "76", "MINEUR", 5, 5, "EN_COURS")],
        "incident_id string, date_detection string, date_debut_incident string, region string, departement string, niveau_severite string, nb_clients_affectes bigint, nb_reclamations_liees bigint, statut string",
        "date_detection", "date_debut_incident",
    )
    matched = clusters.match_open_incidents(found, known)
    merged = {r.incident_id: r for r in clusters.merge_incidents(matched, known).collect()}
    assert (merged["K1"].nb_clients_affectes, merged["K1"].nb_reclamations_liees) == (40, 99)
    assert merged["K2"].nb_clients_affectes == 5  # one second too early
    assert merged["INC-76-2024010102-0012"].niveau_severite == "MINEUR"
    assert {r.niveau_severite for r in clusters.refresh_severity(clusters.merge_incidents(matched, known)).filter("incident_id = 'K1'").collect()} == {"MODERE"}


def test_fraud_levels(spark):
    rows = [("M1", "CONSO_PENDANT_COUPURE", "CRITIQUE")] * 3 + [("M2", "DELTA_INDEX", "MODEREE")] * 4 + [("M3", "CONSO_NULLE", "FAIBLE")] * 2 + [("M4", "AUTRE", "CRITIQUE")]
    df = spark.createDataFrame([(m, 1, t, s) for m, t, s in rows], "numero_compteur string, client_id int, type_anomalie string, severite string")
    df = df.withColumn("date_detection", F.lit("2024-01-10").cast("date"))
    got = {r.numero_compteur: (r.score_fraude, r.niveau_risque) for r in fraud.scores(df, "2024-01-20").collect()}
    assert got == {"M1": (100.0, "CONFIRME"), "M2": (100.0, "ELEVE"), "M3": (15.0, "MODERE")}


def test_twin_profiles_need_same_zone_and_days(spark):
    rows = [(1, 10, "2024-01-05", 60.0), (1, 11, "2024-01-05", 70.0), (2, 12, "2024-01-05", 60.0), (1, 13, "2024-01-06", 60.0), (1, 14, "2024-01-05", 60.0), (1, 14, "2024-01-06", 10.0)]
    df = spark.createDataFrame(rows, "zone int, numero_compteur int, d string, consommation_kwh double").withColumn("date_releve", F.col("d").cast("date"))
    got = sorted(r.numero_compteur for r in fraud.twin_profiles(df, "2024-01-31").collect())
    assert got == [10, 11]


def test_weather_only_replaces_defaults_and_takes_the_worst(spark):
    rows = [("A", 1, 30.0, 0.0, 0.0, 10.0, 10.0, "VERTE", "AUCUN"), ("A", 2, 30.0, 0.0, 0.0, 10.0, 10.0, "JAUNE", "ORAGE"), ("A", 3, 1.0, 0.0, 0.0, -9.0, 10.0, "VERTE", "AUCUN")]
    df = spark.createDataFrame(rows, "region string, departement int, vent_rafales_ms double, precipitation_mm double, neige_cm double, temperature_min_c double, temperature_max_c double, vigilance_meteo string, type_phenomene string")
    df = df.withColumn("date_mesure", F.lit("2024-01-01").cast("date"))
    classified = weather.classify(df)
    assert {(r.departement, r.vigilance_meteo, r.type_phenomene) for r in classified.collect()} == {(1, "ROUGE", "VENT_VIOLENT"), (2, "JAUNE", "ORAGE"), (3, "VERTE", "GEL")}
    assert [(r.vigilance_meteo, r.type_phenomene) for r in weather.worst_per_region(classified).collect()] == [("ROUGE", "VENT_VIOLENT")]


def test_compliance_reasons(spark):
    df = spark.createDataFrame([("A", "1", 1.0, 80.0), ("A", "2", 0.1, 95.0), ("A", "3", None, None), ("A", "4", 0.0, 0.0)], "region string, departement string, saidi_minutes double, taux_respect_delai_raccordement double")
    got = {r.departement: (r.conforme_cre, r.motif_non_conformite) for r in regulatory.with_compliance(df).collect()}
    assert got["1"] == (False, "SAIDI annualisé=365.0000min > seuil=60min; Taux raccordement=80.00% < 90%")
    assert got["2"] == got["3"] == got["4"] == (True, None)
    assert regulatory.alerts(df).count() == 2


def test_weekly_evolution_without_base_is_null(spark):
    rows = [("2024-01-16", "A", "T", 3, 2), ("2024-01-09", "A", "T", 2, 2), ("2024-01-17", "B", "T", 1, 0)]
    df = spark.createDataFrame(rows, "d string, region string, type_reclamation string, nombre_ouvertes bigint, nombre_cloturees bigint").withColumns(
        {
            "date_calcul": F.col("d").cast("date"),
            "nombre_reclamations_total": F.lit(10),
            "nb_critiques": F.lit(1),
            "duree_moyenne_traitement": F.lit(1.0),
            "duree_mediane_traitement": F.lit(1.0),
            "taux_respect_sla": F.lit(50.0),
        }
    )
    got = {r.region: (r.semaine, r.evolution_vs_semaine_precedente) for r in kpi.weekly(df, "2024-01-22").collect()}
    assert got == {"A": (3, 25.0), "B": (3, None)}


def test_pseudonym_is_stable_and_total(spark):
    import hashlib

    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, client_id int")
    requests = spark.createDataFrame([(1, 5), (2, 5)], "id int, client_id int")
    got = {r.id: r.client_id for r in privacy.pseudonymise(df, requests, "2024-01-01").collect()}
    assert got == {1: "SUPPRIME_" + hashlib.sha256(b"5_rgpd_2024-01-01").hexdigest()[:12], 2: "6", 3: None}


def test_archive_split_adds_up(spark):
    df = stamped(spark, [(1, "2020-01-01"), (2, "2024-01-01"), (3, None)], "id int, at string", "at")
    old, kept = privacy.split_archive(df, "at", "2024-06-01", 12)
    assert [r.id for r in old.collect()] == [1]
    assert sorted(r.id for r in kept.collect()) == [2, 3]


def test_health_score_counts_slow_jobs_twice_and_is_clamped(spark):
    runs = stamped(
        spark,
        [("a", "SUCCESS", 100.0, 1, "2024-01-01 10:00:00"), ("a", "FAILED", 1.0, 1, "2024-01-01 09:00:00"), ("b", "FAILED", 1.0, 1, "2024-01-01 10:00:00"), ("c", "SUCCESS", 1.0, 1, "2023-12-01 10:00:00")],
        "dag_id string, status string, duration_seconds double, rows_processed int, created_at string", "created_at",
    )
    policy = monitoring.policy_frame(spark, {"a": 26, "b": 26, "c": 26, "d": 26}, {"a": 50})
    states = monitoring.job_states(runs, policy, "2024-01-01 12:00:00")
    assert {r.dag_id: (r.etat, r.lent) for r in states.collect()} == {"a": ("OK", True), "b": ("ECHEC", False), "c": ("MANQUANT", False), "d": ("MANQUANT", False)}
    assert monitoring.health_score(states).first().score == 30.0
    only = monitoring.job_states(runs.filter("dag_id = 'a'"), monitoring.policy_frame(spark, {"a": 26}, {"a": 50}), "2024-01-01 12:00:00")
    assert monitoring.health_score(only).first().score == 100.0


@pytest.mark.parametrize("volume,level,degraded", [(0, "NORMAL", 0), (2000, "ELEVE", 1), (5000, "CRITIQUE", 2), (9000, "CRISE", 3)])
def test_load_levels(spark, volume, level, degraded):
    row = monitoring.with_load(spark.createDataFrame([(volume,)], "volume int")).first()
    assert (row.niveau_charge, row.niveau_degrade, row.mode_degrade) == (level, degraded, degraded >= 2)


def test_rates_are_null_on_empty_base(spark):
    assert spark.range(1).select(C.rate(F.lit(1), F.lit(0)), C.evolution(F.lit(1), F.lit(0))).first()[:] == (None, None)
