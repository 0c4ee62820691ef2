"""Key figures per region, type and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D

REGION_TYPE = ("region", "type_reclamation")


def _count(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def gold_daily(enriched: DataFrame, as_of: str | Column, keys: Sequence[str] = REGION_TYPE) -> DataFrame:
    """Totals, open, closed, mean and approximate median duration, first reply, critical, recurrent."""
    return (
        enriched.groupBy(*keys)
        .agg(
            _count().alias("nombre_reclamations_total"),
            _count(C.is_open()).alias("nombre_ouvertes"),
            _count(F.col("statut") == "CLOTURE").alias("nombre_cloturees"),
            F.avg("duree_traitement_heures").alias("duree_moyenne_traitement"),
            F.percentile_approx("duree_traitement_heures", 0.5).alias("duree_mediane_traitement"),
            F.avg("delai_premiere_reponse_heures").alias("delai_moyen_premiere_reponse"),
            _count(F.col("priorite") == "CRITIQUE").alias("nb_critiques"),
            _count(F.col("est_recurrent")).alias("nb_recurrentes"),
        )
        .withColumn("date_calcul", C.day(as_of))
    )


def region_analytics(enriched: DataFrame, as_of: str | Column) -> DataFrame:
    total = _count()
    return (
        enriched.groupBy("region")
        .agg(
            total.alias("total_reclamations"),
            F.avg("score_priorite").alias("score_priorite_moyen"),
            F.avg("duree_traitement_heures").alias("duree_moyenne_traitement"),
            C.rate(_count(F.col("est_recurrent")), total).alias("taux_recurrence_pct"),
            _count(C.is_open()).alias("en_cours"),
            _count(F.col("priorite") == "CRITIQUE").alias("nb_critiques"),
        )
        .withColumn("date_snapshot", C.day(as_of))
    )


def volumes(df: DataFrame, keys: Sequence[str] = REGION_TYPE) -> DataFrame:
    return df.groupBy(*keys).agg(
        _count().alias("nombre_reclamations"),
        _count(C.is_open()).alias("nombre_ouvertes"),
        _count(F.col("statut") == "CLOTURE").alias("nombre_cloturees"),
    )


def delays(df: DataFrame, keys: Sequence[str] = REGION_TYPE) -> DataFrame:
    """Duration figures over closed complaints."""
    return (
        df.filter(F.col("duree_traitement_heures").isNotNull())
        .groupBy(*keys)
        .agg(
            F.avg("duree_traitement_heures").alias("duree_moyenne_traitement"),
            F.percentile_approx("duree_traitement_heures", 0.5).alias("duree_mediane_traitement"),
            F.avg("delai_premiere_reponse_heures").alias("delai_moyen_premiere_reponse_heures"),
        )
    )


def sla_rates(df: DataFrame, keys: Sequence[str] = REGION_TYPE) -> DataFrame:
    """Deadline, critical and escalation rates over closed complaints."""
    met = F.col("duree_traitement_heures") <= C.sla_limit(default=None)
    total = _count()
    return (
        df.filter(F.col("duree_traitement_heures").isNotNull())
        .groupBy(*keys)
        .agg(
            total.alias("total_reclamations_traitees"),
            _count(met).alias("nb_respect_sla"),
            _count(F.col("priorite") == "CRITIQUE").alias("nb_critiques"),
            _count(F.col("statut") == "ESCALADE").alias("nb_escalades"),
            C.rate(_count(met), total).alias("taux_respect_sla"),
            C.rate(_count(F.col("priorite") == "CRITIQUE"), total).alias("taux_critique"),
            C.rate(_count(F.col("statut") == "ESCALADE"), total).alias("taux_escalade"),
        )
    )


def merged(volume: DataFrame, delay: DataFrame, sla: DataFrame, keys: Sequence[str] = REGION_TYPE) -> DataFrame:
    """Full outer merge of the three indicator sets on the same keys."""
    keys = list(keys)
    return (
        volume.join(delay, keys, "outer")
        .join(sla, keys, "outer")
        .select(
            *keys,
            "nombre_reclamations",
            "nombre_ouvertes",
            "nombre_cloturees",
            "duree_moyenne_traitement",
            "duree_mediane_traitement",
            "delai_moyen_premiere_reponse_heures",
            "taux_respect_sla",
            "nb_critiques",
            "taux_critique",
            "taux_escalade",
        )
    )


def indicators(df: DataFrame, keys: Sequence[str] = REGION_TYPE) -> DataFrame:
    """The merged volume, delay and deadline figures from a single scan.

    Same result as :func:`merged` on the three separate sets; use that one when the
    sets are stored tables.
    """
    closed = F.col("duree_traitement_heures").isNotNull()
    nb = F.nullif(_count(closed), F.lit(0))
    met = F.col("duree_traitement_heures") <= C.sla_limit(default=None)
    critical, escalated = F.col("priorite") == "CRITIQUE", F.col("statut") == "ESCALADE"
    return df.groupBy(*keys).agg(
        _count().alias("nombre_reclamations"),
        _count(C.is_open()).alias("nombre_ouvertes"),
        _count(F.col("statut") == "CLOTURE").alias("nombre_cloturees"),
        F.avg("duree_traitement_heures").alias("duree_moyenne_traitement"),
        F.percentile_approx("duree_traitement_heures", 0.5).alias("duree_mediane_traitement"),
        F.avg(F.when(closed, F.col("delai_premiere_reponse_heures"))).alias("delai_moyen_premiere_reponse_heures"),
        C.rate(_count(met), nb).alias("taux_respect_sla"),
        F.when(nb.isNotNull(), _count(closed & critical)).alias("nb_critiques"),
        C.rate(_count(closed & critical), nb).alias("taux_critique"),
        C.rate(_count(closed & escalated), nb).alias("taux_escalade"),
    )


def daily_history(df: DataFrame) -> DataFrame:
    """Daily KPI table by creation day, region and type, from complaints with exact durations."""
    met = F.col("duree_traitement_heures") <= C.sla_limit(default=None)
    closed = F.col("duree_traitement_heures").isNotNull()
    total = _count()
    return df.groupBy(F.to_date("date_creation").alias("date_calcul"), "region", "type_reclamation").agg(
        total.alias("nombre_reclamations_total"),
        _count(C.is_open()).alias("nombre_ouvertes"),
        _count(F.col("statut") == "CLOTURE").alias("nombre_cloturees"),
        F.avg("duree_traitement_heures").alias("duree_moyenne_traitement"),
        F.percentile_approx("duree_traitement_heures", 0.5).alias("duree_mediane_traitement"),
        C.rate(_count(met), _count(closed)).alias("taux_respect_sla"),
        _count(F.col("priorite") == "CRITIQUE").alias("nb_critiques"),
        C.rate(_count(F.col("statut") == "ESCALADE"), total).alias("taux_escalade"),
    )


def _period(kpis: DataFrame, start: Column, end: Column) -> DataFrame:
    return kpis.filter(F.col("date_calcul").between(start, end))


def _volume(kpis: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    return (
        _period(kpis, start, end)
        .groupBy(*REGION_TYPE)
        .agg(F.sum(F.col("nombre_ouvertes") + F.col("nombre_cloturees")).alias(name))
    )


def _figures() -> list[Column]:
    return [
        F.sum(F.col("nombre_ouvertes") + F.col("nombre_cloturees")).alias("total_reclamations"),
        F.sum("nombre_ouvertes").alias("total_ouvertes"),
        F.sum("nombre_cloturees").alias("total_cloturees"),
        C.rounded(F.avg("duree_moyenne_traitement"), 2).alias("duree_moyenne_heures"),
        C.rounded(F.avg("duree_mediane_traitement"), 2).alias("duree_mediane_heures"),
        C.rounded(F.avg("taux_respect_sla"), 2).alias("taux_respect_sla"),
        C.rounded(F.avg("nb_critiques"), 2).alias("taux_critique"),
    ]


def weekly(kpis: DataFrame, run_date: str) -> DataFrame:
    """Figures of the seven days before ``run_date`` with the change against the week before."""
    run = F.lit(run_date).cast("date")
    start, end = F.date_sub(run, 7), F.date_sub(run, 1)
    share = F.try_divide(F.col("nb_critiques").cast("double"), F.col("nombre_reclamations_total"))
    current = _period(kpis, start, end).groupBy(*REGION_TYPE).agg(
        *_figures(), C.rounded((1 - F.avg(share)) * 100, 2).alias("taux_non_critique")
    )
    previous = _volume(kpis, F.date_sub(start, 7), F.date_sub(start, 1), "_prec")
    return current.join(previous, list(REGION_TYPE), "left").select(
        F.extract(F.lit("YEAROFWEEK"), start).alias("annee"),
        F.extract(F.lit("WEEK"), start).alias("semaine"),
        start.alias("debut_semaine"),
        end.alias("fin_semaine"),
        *current.columns,
        C.rounded(C.evolution(F.col("total_reclamations"), F.col("_prec")), 2).alias("evolution_vs_semaine_precedente"),
    )


def weekly_history(kpis: DataFrame) -> DataFrame:
    """The figures of ``weekly`` for every calendar week there is, each against the week before it."""
    share = F.try_divide(F.col("nb_critiques").cast("double"), F.col("nombre_reclamations_total"))
    keys = ["debut_semaine", *REGION_TYPE]
    weeks = (
        kpis.withColumn("debut_semaine", F.trunc("date_calcul", "week"))
        .groupBy(*keys)
        .agg(*_figures(), C.rounded((1 - F.avg(share)) * 100, 2).alias("taux_non_critique"))
    )
    before = weeks.select(
        F.date_add("debut_semaine", 7).alias("debut_semaine"), *REGION_TYPE, F.col("total_reclamations").alias("_prec")
    )
    start = F.col("debut_semaine")
    return weeks.join(before, keys, "left").select(
        F.extract(F.lit("YEAROFWEEK"), start).alias("annee"),
        F.extract(F.lit("WEEK"), start).alias("semaine"),
        start,
        F.date_add(start, 6).alias("fin_semaine"),
        *[c for c in weeks.columns if c != "debut_semaine"],
        C.rounded(C.evolution(F.col("total_reclamations"), F.col("_prec")), 2).alias("evolution_vs_semaine_precedente"),
    )


def weekly_summary(weeks: DataFrame) -> DataFrame:
    """Totals per type for the latest week."""
    latest = weeks.agg(F.max("debut_semaine").alias("_latest"))
    return (
        weeks.join(F.broadcast(latest), F.col("debut_semaine") == F.col("_latest"))
        .groupBy("type_reclamation")
        .agg(
            F.sum("total_reclamations").alias("total"),
            C.exact_avg("taux_respect_sla", 1).alias("taux_sla_moy"),
            C.exact_avg("evolution_vs_semaine_precedente", 1).alias("evolution"),
        )
        .orderBy(F.desc("total"), "type_reclamation")
    )


def monthly(kpis: DataFrame, run_date: str) -> DataFrame:
    """Figures of the month before ``run_date``, against the month before it and the same month last year."""
    run = F.lit(run_date).cast("date")
    start = F.add_months(F.trunc(run, "month"), -1)
    end = F.last_day(start)

    def shifted(months: int) -> tuple[Column, Column]:
        first = F.add_months(start, months)
        return first, F.last_day(first)

    current = _period(kpis, start, end).groupBy(*REGION_TYPE).agg(
        *_figures(), C.rounded(F.avg("taux_escalade"), 2).alias("taux_escalade")
    )
    return (
        current.join(_volume(kpis, *shifted(-1), "_m1"), list(REGION_TYPE), "left")
        .join(_volume(kpis, *shifted(-12), "_an"), list(REGION_TYPE), "left")
        .select(
            F.year(start).alias("annee"),
            F.month(start).alias("mois"),
            *current.columns,
            C.rounded(C.evolution(F.col("total_reclamations"), F.col("_m1")), 2).alias("evolution_vs_mois_precedent"),
            C.rounded(C.evolution(F.col("total_reclamations"), F.col("_an")), 2).alias("evolution_vs_meme_mois_an_dernier"),
            C.sla_limit(default=None).alias("sla_cible"),
        )
    )


def monthly_sla_report(months: DataFrame, label: str) -> DataFrame:
    """Deadline compliance per type for the month ``yyyy-MM``."""
    month = F.concat_ws("-", F.col("annee").cast("string"), F.lpad(F.col("mois").cast("string"), 2, "0"))
    return (
        months.filter(month == label)
        .groupBy("type_reclamation", "sla_cible")
        .agg(
            F.sum("total_reclamations").alias("total"),
            C.exact_avg("taux_respect_sla", 1).alias("taux_sla_moy"),
            F.min("taux_respect_sla").alias("taux_sla_min"),
            C.exact_avg("evolution_vs_mois_precedent", 1).alias("evol_m1"),
        )
        .orderBy("taux_sla_moy", "type_reclamation")
    )


def sla_summary(kpis: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Region and type overview of the last days."""
    return (
        kpis.filter(F.col("date_calcul") >= F.date_sub(F.lit(as_of).cast("date"), days))
        .groupBy(*REGION_TYPE)
        .agg(
            F.sum("nombre_reclamations_total").alias("total_reclamations"),
            F.sum("nombre_ouvertes").alias("en_cours"),
            C.rounded(F.avg("taux_respect_sla"), 2).alias("taux_sla_moyen"),
            C.rounded(F.avg("duree_moyenne_traitement"), 2).alias("duree_moyenne_h"),
            F.max("date_calcul").alias("derniere_date"),
        )
    )


def trends(kpis: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Daily volume and rates per type with a moving average over seven rows.

    The window runs on one row per type and day, so its groups are bounded by the
    number of days whatever the number of complaints.
    """
    daily = (
        kpis.filter(F.col("date_calcul") >= F.date_sub(F.lit(as_of).cast("date"), days))
        .groupBy("date_calcul", "type_reclamation")
        .agg(
            F.sum(F.col("nombre_ouvertes") + F.col("nombre_cloturees")).alias("volume_total"),
            F.avg("taux_respect_sla").alias("_sla"),
            F.avg("duree_moyenne_traitement").alias("_duree"),
        )
    )
    last_seven = W.partitionBy("type_reclamation").orderBy("date_calcul").rowsBetween(-6, 0)
    return daily.select(
        "date_calcul",
        "type_reclamation",
        "volume_total",
        C.rounded("_sla", 2).alias("taux_sla"),
        C.rounded("_duree", 2).alias("duree_moy"),
        C.rounded(F.avg("_sla").over(last_seven), 2).alias("taux_sla_mm7j"),
    )


def sla_by_region(kpis: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    """Extract for reporting: one row per day, region and type."""
    return (
        kpis.filter(F.col("date_calcul") >= F.date_sub(F.lit(as_of).cast("date"), days))
        .groupBy("date_calcul", *REGION_TYPE)
        .agg(
            C.rounded(F.avg("taux_respect_sla"), 2).alias("taux_sla_moyen"),
            F.sum(F.col("nombre_ouvertes") + F.col("nombre_cloturees")).alias("volume_total"),
            C.rounded(F.avg("duree_moyenne_traitement"), 2).alias("duree_moy"),
        )
    )


def top_meter_faults(detail: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return (
        detail.filter(F.col("export_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
        .groupBy("region", "type_panne")
        .agg(
            _count().alias("occurrences"),
            C.rounded(F.avg("duree_heures"), 1).alias("duree_moyenne_h"),
            F.max("export_date").alias("derniere_observation"),
        )
        .orderBy(F.desc("occurrences"), "region", "type_panne")
    )


def complaint_daily(df: DataFrame) -> DataFrame:
    """Daily KPIs with breach count and recurrence share, per day, region and type."""
    met = F.col("sla_respecte")
    total = _count()
    return df.groupBy(F.to_date("date_creation").alias("jour"), *REGION_TYPE).agg(
        total.alias("nb_reclamations_total"),
        _count(F.col("statut") == "OUVERT").alias("nb_reclamations_ouvertes"),
        _count(F.col("statut") == "CLOTURE").alias("nb_reclamations_closes"),
        F.avg("duree_traitement_heures").alias("duree_moyenne_traitement_heures"),
        C.rate(_count(met), total).alias("taux_respect_sla"),
        _count(~met).alias("nb_depassements_sla"),
        C.rate(_count(F.col("est_recurrent")), total).alias("taux_recurrence"),
    )


def region_statistics(df: DataFrame) -> DataFrame:
    total = _count()
    return df.groupBy("region").agg(
        total.alias("total_reclamations"),
        F.count_distinct("client_id").alias("nb_clients"),
        _count(C.is_open()).alias("en_cours"),
        _count(F.col("statut") == "CLOTURE").alias("cloturees"),
        F.avg("duree_traitement_heures").alias("duree_moyenne_heures"),
    )


def top_clients(df: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` clients with most complaints (a report limit)."""
    return (
        df.groupBy("client_id")
        .agg(_count().alias("nb_reclamations"), F.max("date_creation").alias("derniere_reclamation"))
        .orderBy(F.desc("nb_reclamations"), "client_id")
        .limit(n)
    )


def problem_meters(df: DataFrame, at_least: int = 2) -> DataFrame:
    """Meters with several complaints or a known defect."""
    return (
        df.groupBy("reference_linky")
        .agg(
            _count().alias("nb_reclamations"),
            F.max(F.col("est_defectueux").cast("int")).alias("est_defectueux"),
            F.max("nombre_incidents").alias("nombre_incidents"),
        )
        .filter((F.col("nb_reclamations") >= at_least) & (F.col("est_defectueux") == 1))
    )


def scenario_summary(df: DataFrame, label: str = "scenario_test") -> DataFrame:
    return df.groupBy(label).agg(
        _count().alias("nb"),
        _count(F.col("statut") == "CLOTURE").alias("cloturees"),
        C.rounded(F.avg("duree_traitement_heures"), 1).alias("duree_moy"),
    )
