"""Meter-fraud signals, scores and surveillance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.functions.skew import attach_group_stats


def _of_day(detail: DataFrame, run_date: str) -> DataFrame:
    """Detail rows of an identified meter exported on the day."""
    return detail.filter(
        F.col("numero_compteur").isNotNull() & (F.col("export_date") == F.lit(run_date).cast("date"))
    )


def zero_readings(detail: DataFrame, complaints: DataFrame) -> DataFrame:
    """Zero-consumption detail rows of meters with a complaint that is not closed."""
    unclosed = complaints.filter(F.col("statut") != "CLOTURE").select("id_reclamation", "client_id")
    zero = detail.filter((F.col("consommation_kwh") == 0) & F.col("numero_compteur").isNotNull())
    return zero.select("id_reclamation", "numero_compteur", "consommation_kwh").join(unclosed, "id_reclamation")


def zero_consumption(detail: DataFrame, complaints: DataFrame, run_date: str, at_least: int = D.ZERO_DAYS) -> DataFrame:
    """Meters with many zero readings."""
    days = F.col("nb_jours_anomalie")
    grouped = (
        zero_readings(detail, complaints)
        .groupBy("numero_compteur", "client_id")
        .agg(F.count(F.lit(1)).alias("nb_jours_anomalie"), F.avg("consommation_kwh").alias("valeur_attendue"))
        .filter(days >= at_least)
    )
    return grouped.select(
        F.lit(run_date).cast("date").alias("date_detection"),
        "numero_compteur",
        "client_id",
        F.lit("CONSO_NULLE").alias("type_anomalie"),
        F.when(days > 30, "CRITIQUE").when(days > 14, "ELEVEE").when(days > at_least, "MODEREE").otherwise("FAIBLE").alias("severite"),
        F.lit(0.0).alias("valeur_mesuree"),
        "valeur_attendue",
        F.lit(100.0).alias("ecart_pct"),
        days.cast("long").alias("nb_jours_anomalie"),
    )


def index_delta(detail: DataFrame, complaints: DataFrame, run_date: str, limit: float = D.INDEX_DELTA_PCT) -> DataFrame:
    """Readings of the day whose index and consumption differ by more than ``limit`` percent."""
    gap = F.col("ecart_index_pct")
    rows = _of_day(detail, run_date).filter(F.abs(gap) > limit)
    return rows.join(complaints.select("id_reclamation", "client_id"), "id_reclamation").select(
        F.lit(run_date).cast("date").alias("date_detection"),
        "numero_compteur",
        "client_id",
        F.lit("DELTA_INDEX").alias("type_anomalie"),
        F.when(F.abs(gap) > 20, "CRITIQUE").when(F.abs(gap) > 10, "ELEVEE").otherwise("MODEREE").alias("severite"),
        F.col("consommation_kwh").alias("valeur_mesuree"),
        (F.col("consommation_kwh") * (1 + gap / 100.0)).alias("valeur_attendue"),
        gap.alias("ecart_pct"),
        F.lit(1).cast("long").alias("nb_jours_anomalie"),
    )


def consumption_during_outage(
    detail: DataFrame, complaints: DataFrame, outages: DataFrame, run_date: str
) -> DataFrame:
    """Readings of the day above zero from clients with an open outage complaint.

    Only the existence of an outage matters, so outages are reduced to their
    clients and used in a semi join: nothing multiplies.
    """
    cut_off = outages.filter(C.is_open()).select("client_id").distinct()
    rows = _of_day(detail, run_date).filter(F.col("consommation_kwh") > 0)
    return (
        rows.join(complaints.select("id_reclamation", "client_id"), "id_reclamation")
        .join(cut_off, "client_id", "left_semi")
        .select(
            F.lit(run_date).cast("date").alias("date_detection"),
            "numero_compteur",
            "client_id",
            F.lit("CONSO_PENDANT_COUPURE").alias("type_anomalie"),
            F.lit("CRITIQUE").alias("severite"),
            F.col("consommation_kwh").alias("valeur_mesuree"),
            F.lit(None).cast("double").alias("valeur_attendue"),
            F.lit(None).cast("double").alias("ecart_pct"),
            F.lit(1).cast("long").alias("nb_jours_anomalie"),
        )
        .distinct()
    )


def meter_anomalies(detail: DataFrame, complaints: DataFrame, outages: DataFrame, run_date: str, at_least: int = D.ZERO_DAYS) -> DataFrame:
    """Bag union of the three detectors."""
    parts = [
        zero_consumption(detail, complaints, run_date, at_least),
        index_delta(detail, complaints, run_date),
        consumption_during_outage(detail, complaints, outages, run_date),
    ]
    return reduce(DataFrame.unionByName, parts)


def scores(anomalies: DataFrame, run_date: str, days: int = 30) -> DataFrame:
    """Score, first date, count and risk level of meters with at least two recent anomalies."""
    weight = C.case("type_anomalie", D.FRAUD_TYPE_WEIGHT, D.FRAUD_TYPE_DEFAULT) * C.case(
        "severite", D.FRAUD_SEVERITY_WEIGHT, D.FRAUD_SEVERITY_DEFAULT
    )
    n, during_outage = F.col("nb_anomalies_30j"), F.col("_outage")
    return (
        anomalies.filter(F.col("date_detection") >= F.date_sub(F.lit(run_date).cast("date"), days))
        .groupBy("numero_compteur")
        .agg(
            F.max("client_id").alias("client_id"),
            F.min("date_detection").alias("date_premiere_anomalie"),
            F.count(F.lit(1)).alias("nb_anomalies_30j"),
            F.least(F.lit(100.0), C.rounded(F.sum(weight), 2)).alias("score_fraude"),
            F.max(F.col("type_anomalie") == "CONSO_PENDANT_COUPURE").alias("_outage"),
        )
        .filter(n >= 2)
        .withColumn(
            "niveau_risque",
            F.when((n >= D.REPORTABLE_ANOMALIES) & during_outage, "CONFIRME")
            .when(n >= D.REPORTABLE_ANOMALIES + 1, "ELEVE")
            .otherwise("MODERE"),
        )
        .drop("_outage")
    )


def to_watch(suspicions: DataFrame, watched: DataFrame, run_date: str) -> DataFrame:
    """High-risk meters not yet under surveillance, with reason and next check a week later."""
    reason = F.concat(
        F.lit("Score fraude "),
        F.col("score_fraude").cast("decimal(5,2)").cast("string"),
        F.lit("/100 — niveau "),
        F.col("niveau_risque"),
    )
    run = F.lit(run_date).cast("date")
    return (
        suspicions.filter(F.col("niveau_risque").isin("ELEVE", "CONFIRME"))
        .join(watched.select("numero_compteur").distinct(), "numero_compteur", "left_anti")
        .select(
            "numero_compteur",
            run.alias("date_mise_surveillance"),
            reason.alias("motif"),
            F.date_add(run, 7).alias("prochain_controle"),
        )
    )


def consumption_peaks(readings: DataFrame, meter: str = "numero_compteur", sigma: float = D.PEAK_SIGMA) -> DataFrame:
    """Readings more than ``sigma`` deviations above the meter's mean."""
    rows = attach_group_stats(
        readings, [meter], moyenne=F.avg("consommation_kwh"), ecart_type=F.stddev("consommation_kwh")
    )
    return rows.filter(F.col("consommation_kwh") > F.col("moyenne") + sigma * F.col("ecart_type"))


def twin_profiles(readings: DataFrame, as_of: str | None = None, days: int | None = None, step: float = 50.0) -> DataFrame:
    """Meters of one zone with the same daily profile, over all days or the last ``days`` days before ``as_of``.

    A profile is the set of (day, consumption in ``step`` kWh bands). It is reduced
    to an order-free fingerprint of two 64-bit hashes and a count, which merges on
    the map side; groups of equal fingerprints replace a comparison of meter pairs. Equality
    is then verified: a (day, band) of a group must be there as often as the group has meters, or
    else the group is left out.
    """
    band = F.floor(F.sum("consommation_kwh") / step)
    per_day = (
        _last_days(readings, as_of, days)
        .groupBy("zone", "numero_compteur", "date_releve")
        .agg(band.alias("bande"))
    )
    profile = per_day.groupBy("zone", "numero_compteur").agg(
        F.count(F.lit(1)).alias("nb_jours"),
        F.bit_xor(F.xxhash64("date_releve", "bande")).alias("_h1"),
        F.bit_xor(F.xxhash64("bande", "date_releve", F.lit(1))).alias("_h2"),
    )
    key = ["zone", "nb_jours", "_h1", "_h2"]
    shared = profile.groupBy(*key).agg(F.count(F.lit(1)).alias("nb_compteurs"), F.min("numero_compteur").alias("premier_compteur"))
    members = profile.join(shared.filter(F.col("nb_compteurs") > 1), key)
    unequal = (
        per_day.join(members.select("zone", "numero_compteur", *key[1:], "nb_compteurs"), ["zone", "numero_compteur"])
        .groupBy(*key, "date_releve", "bande")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("nb_compteurs").alias("_of"))
        .filter(F.col("_n") != F.col("_of"))
        .select(*key)
        .distinct()
    )
    return members.join(unequal, key, "left_anti").select(
        "zone", "numero_compteur", "nb_jours", "nb_compteurs", "premier_compteur"
    )


def _last_days(readings: DataFrame, as_of: str | None, days: int | None) -> DataFrame:
    if as_of is None or days is None:
        return readings
    until = F.lit(as_of).cast("date")
    return readings.filter((F.col("date_releve") > F.date_sub(until, days)) & (F.col("date_releve") <= until))
