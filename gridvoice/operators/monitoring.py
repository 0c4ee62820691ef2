"""Freshness, job health and load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.operators import enrich

TIME_PREFERENCES = ("created_at", "export_date", "run_date")


def status_band(score: str | Column, good: float, fair: float, labels: Sequence[str] = ("OK", "WARNING", "ALERT")) -> Column:
    return C.banded(score, [(good, labels[0]), (fair, labels[1])], labels[2])


def freshness(
    tables: Mapping[str, DataFrame],
    thresholds: Mapping[str, float],
    as_of: str,
    preferences: Sequence[str] = TIME_PREFERENCES,
    critical: Sequence[str] = (),
) -> DataFrame:
    """Age of the newest row per table against its limit in hours."""
    parts = []
    for name, df in tables.items():
        column = enrich.first_available(df, preferences)
        latest = F.max(F.col(column).cast("timestamp")) if column else F.lit(None).cast("timestamp")
        parts.append(
            df.agg(latest.alias("derniere")).select(
                F.lit(name).alias("nom_table"), "derniere", F.lit(float(thresholds[name])).alias("seuil_heures")
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    age = C.hours_between(C.moment(as_of), "derniere")
    fresh = F.coalesce(F.col("age_heures") <= F.col("seuil_heures"), F.lit(False))
    level = F.when(F.col("nom_table").isin(*critical), "CRITIQUE") if critical else F
    return rows.withColumn("age_heures", C.rounded(age, 2)).select(
        "nom_table",
        "age_heures",
        "seuil_heures",
        fresh.alias("a_jour"),
        F.when(~fresh, (level.otherwise("ATTENTION") if critical else F.lit("ATTENTION"))).alias("niveau_alerte"),
    )


def freshness_score(report: DataFrame) -> DataFrame:
    score = C.rounded(F.avg(F.col("a_jour").cast("double")) * 100, 1)
    return report.agg(
        F.count(F.lit(1)).alias("nb_tables"), F.count_if("a_jour").alias("nb_a_jour"), score.alias("score")
    ).withColumn("statut", status_band("score", 95, 80))


def policy_frame(spark: SparkSession, max_absence: Mapping[str, int], slow: Mapping[str, int]) -> DataFrame:
    rows = [(job, hours, slow.get(job)) for job, hours in max_absence.items()]
    return spark.createDataFrame(rows, "dag_id string, absence_max_h int, seuil_lent_s int")


def job_states(runs: DataFrame, policy: DataFrame, as_of: str) -> DataFrame:
    """State of each expected job from its latest run: missing, failed or ok, and whether it was slow.

    The latest run is an aggregate over an ordered struct, merged on the map side.
    """
    last = runs.groupBy("dag_id").agg(
        F.max(F.struct("created_at", "rows_processed", "status", "duration_seconds")).alias("_l")
    )
    rows = policy.join(last, "dag_id", "left").select(
        "dag_id",
        "absence_max_h",
        "seuil_lent_s",
        F.col("_l.status").alias("status"),
        F.col("_l.duration_seconds").alias("duration_seconds"),
        C.hours_between(C.moment(as_of), "_l.created_at").alias("age_h"),
    )
    absent = F.col("age_h").isNull() | (F.col("age_h") > F.col("absence_max_h"))
    failed = F.col("status").isin("FAILED", "ERROR", "ALERT")
    state = F.when(absent, "MANQUANT").when(failed, "ECHEC").otherwise("OK")
    slow = (state == "OK") & F.coalesce(F.col("duration_seconds") > F.col("seuil_lent_s"), F.lit(False))
    return rows.select("dag_id", "status", "duration_seconds", C.rounded("age_h", 2).alias("age_h"), state.alias("etat"), slow.alias("lent"))


def health_score(states: DataFrame) -> DataFrame:
    """1 point per ok job, 0.7 more when it was slow, −0.5 per failed one, as a percentage kept in 0–100."""
    ok, slow = F.count_if(F.col("etat") == "OK"), F.count_if("lent")
    failed, missing = F.count_if(F.col("etat") == "ECHEC"), F.count_if(F.col("etat") == "MANQUANT")
    total = F.count(F.lit(1))
    raw = C.rounded(100 * (ok + slow * 0.7 - failed * 0.5) / total, 1)
    return states.agg(
        ok.alias("nb_ok"),
        slow.alias("nb_lents"),
        failed.alias("nb_echecs"),
        missing.alias("nb_manquants"),
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)).alias("score"),
    ).withColumn("statut", status_band("score", 90, 70, ("OK", "WARNING", "CRITICAL")))


def load_ratio(volume: str | Column, per_day: int = D.BASELINE_PER_DAY) -> Column:
    """Hourly volume as a multiple of the hourly baseline."""
    return C.col(volume) / (per_day / 24)


def load_level(ratio: str | Column) -> Column:
    return C.banded(ratio, [(bound, name) for bound, name, _ in D.LOAD_LEVELS], "NORMAL")


def degraded_level(ratio: str | Column) -> Column:
    return C.banded(ratio, [(bound, level) for bound, _, level in D.LOAD_LEVELS], 0)


def with_load(df: DataFrame, volume: str = "volume", per_day: int = D.BASELINE_PER_DAY) -> DataFrame:
    ratio = load_ratio(volume, per_day)
    return df.withColumns(
        {
            "ratio_baseline": C.rounded(ratio, 2),
            "niveau_charge": load_level(ratio),
            "mode_degrade": load_level(ratio).isin("CRITIQUE", "CRISE"),
            "niveau_degrade": degraded_level(ratio),
        }
    )


def hourly_load(complaints: DataFrame, per_day: int = D.BASELINE_PER_DAY) -> DataFrame:
    """Complaints per hour with the load level."""
    per_hour = complaints.groupBy(F.window("date_creation", "1 hour").alias("_w")).agg(F.count(F.lit(1)).alias("volume"))
    return with_load(per_hour.select(F.col("_w.start").alias("heure"), "volume"), per_day=per_day)


def last_hour_load(complaints: DataFrame, as_of: str, per_day: int = D.BASELINE_PER_DAY) -> DataFrame:
    since = C.moment(as_of) - F.expr("INTERVAL 1 HOUR")
    recent = complaints.filter((F.col("date_creation") >= since) & (F.col("date_creation") < C.moment(as_of)))
    return with_load(recent.agg(F.count(F.lit(1)).alias("volume")), per_day=per_day)


def recovery(complaints: DataFrame, as_of: str, hours: int = 2, per_day: int = D.BASELINE_PER_DAY) -> DataFrame:
    """Whether each of the last ``hours`` hours stayed below the critical level (empty hours are stable)."""
    critical = min(bound for bound, name, _ in D.LOAD_LEVELS if name == "CRITIQUE")
    at = C.moment(as_of)
    since = at - F.expr(f"INTERVAL {int(hours)} HOURS")
    recent = complaints.filter((F.col("date_creation") >= since) & (F.col("date_creation") < at))
    slot = F.floor((F.unix_timestamp(at) - F.unix_timestamp("date_creation") - 1) / 3600)
    busy = (
        recent.groupBy(slot.alias("_slot"))
        .agg(F.count(F.lit(1)).alias("volume"))
        .filter(load_ratio("volume", per_day) >= critical)
    )
    return busy.agg((F.lit(hours) - F.count(F.lit(1))).alias("heures_stables")).withColumn(
        "retour_normal", F.col("heures_stables") >= hours
    )
