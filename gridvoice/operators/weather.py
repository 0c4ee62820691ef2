"""Weather vigilance and its effect on outage volumes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D

MEASURES = {"rafales": "vent_rafales_ms", "pluie": "precipitation_mm", "neige": "neige_cm"}
LEVELS = ["VERTE", "JAUNE", "ORANGE", "ROUGE"]


def _reaches(limits: dict[str, float]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(MEASURES[k]) >= v for k, v in limits.items()])


def vigilance_level() -> Column:
    return (
        F.when(_reaches(D.WEATHER_RED), "ROUGE")
        .when(_reaches(D.WEATHER_ORANGE), "ORANGE")
        .when(_reaches(D.WEATHER_YELLOW), "JAUNE")
        .otherwise("VERTE")
    )


def phenomenon() -> Column:
    """Wind, snow, rain, heat, frost, in that order."""
    orange = D.WEATHER_ORANGE
    return (
        F.when(F.col("vent_rafales_ms") >= orange["rafales"], "VENT_VIOLENT")
        .when(F.col("neige_cm") >= orange["neige"], "NEIGE_VERGLAS")
        .when(F.col("precipitation_mm") >= orange["pluie"], "PLUIE_INTENSE")
        .when(F.col("temperature_max_c") >= D.HEAT_C, "CANICULE")
        .when(F.col("temperature_min_c") <= D.FROST_C, "GEL")
        .otherwise("NORMAL")
    )


def classify(weather: DataFrame, day: str | None = None) -> DataFrame:
    """Set level and phenomenon where they still hold their defaults (of one day when given)."""
    unset = (F.col("vigilance_meteo") == "VERTE") | (F.col("type_phenomene") == "AUCUN")
    if day is not None:
        unset = unset & (F.col("date_mesure") == F.lit(day).cast("date"))
    return weather.withColumns(
        {
            "vigilance_meteo": F.when(unset, vigilance_level()).otherwise(F.col("vigilance_meteo")),
            "type_phenomene": F.when(unset, phenomenon()).otherwise(F.col("type_phenomene")),
        }
    )


def _rank(level: str = "vigilance_meteo") -> Column:
    return C.case(level, {name: i for i, name in enumerate(LEVELS)}, 0)


def worst_per_region(weather: DataFrame) -> DataFrame:
    """One row per region and day: the worst level, with its smallest phenomenon name."""
    levels = weather.groupBy("date_mesure", "region", "vigilance_meteo").agg(F.min("type_phenomene").alias("_p"))
    return (
        levels.groupBy("date_mesure", "region")
        .agg(F.max(F.struct(_rank().alias("r"), F.col("vigilance_meteo").alias("v"), F.col("_p").alias("p"))).alias("_w"))
        .select("date_mesure", "region", F.col("_w.v").alias("vigilance_meteo"), F.col("_w.p").alias("type_phenomene"))
    )


def day_class(level: str | Column) -> Column:
    return C.case(level, {"ROUGE": "CRISE_METEO", "ORANGE": "TEMPETE", "JAUNE": "METEO_MODEREE"}, "NORMAL")


def outage_baseline(kpis: DataFrame, weather: DataFrame, run_date: str, days: int = 30) -> DataFrame:
    """Mean outage volume per region over the calm days before ``run_date``."""
    run = F.lit(run_date).cast("date")
    rough = weather.filter(F.col("vigilance_meteo").isin("ORANGE", "ROUGE")).select(
        F.col("date_mesure").alias("date_calcul"), "region"
    )
    return (
        kpis.filter(
            F.col("date_calcul").between(F.date_sub(run, days), F.date_sub(run, 1))
            & (F.col("type_reclamation") == "COUPURE_ELECTRIQUE")
        )
        .join(rough, ["date_calcul", "region"], "left_anti")
        .groupBy("region")
        .agg(F.avg(F.col("nombre_ouvertes") + F.col("nombre_cloturees")).alias("baseline_coupures"))
    )


def impact(kpis: DataFrame, weather: DataFrame, run_date: str) -> DataFrame:
    """Outages of the day against the calm-day baseline, with the day's weather.

    ``weather`` has one row per region and day (see :func:`worst_per_region`).
    """
    run = F.lit(run_date).cast("date")
    today = (
        kpis.filter((F.col("date_calcul") == run) & (F.col("type_reclamation") == "COUPURE_ELECTRIQUE"))
        .groupBy("region")
        .agg(F.sum(F.col("nombre_ouvertes") + F.col("nombre_cloturees")).alias("nb_coupures_jour"))
    )
    conditions = weather.filter(F.col("date_mesure") == run).select("region", "vigilance_meteo", "type_phenomene")
    base, count = F.col("baseline_coupures"), F.col("nb_coupures_jour")
    level = F.coalesce("vigilance_meteo", F.lit("VERTE"))
    return (
        today.join(outage_baseline(kpis, weather, run_date), "region", "left")
        .join(conditions, "region", "left")
        .select(
            run.alias("date_calcul"),
            "region",
            "nb_coupures_jour",
            C.rounded(base, 2).alias("nb_coupures_baseline"),
            C.rounded(count - F.coalesce(base, count.cast("double")), 2).alias("surplus_coupures"),
            C.rounded(F.when(base > 0, 100.0 * (count - base) / base).otherwise(0.0), 2).alias("impact_meteo_pct"),
            level.alias("vigilance_jour"),
            F.coalesce("type_phenomene", F.lit("NORMAL")).alias("type_phenomene"),
            day_class(level).alias("classification_jour"),
        )
    )


def report(impacts: DataFrame, weather: DataFrame, run_date: str) -> DataFrame:
    """Impacts with the recorded vigilance, strongest first."""
    recorded = weather.select(F.col("date_mesure").alias("date_calcul"), "region", "vigilance_meteo")
    return (
        impacts.filter(F.col("date_calcul") == F.lit(run_date).cast("date"))
        .join(recorded, ["date_calcul", "region"], "left")
        .select(
            "region",
            "nb_coupures_jour",
            "nb_coupures_baseline",
            "impact_meteo_pct",
            "classification_jour",
            "vigilance_meteo",
        )
        .orderBy(F.desc("impact_meteo_pct"), "region")
    )


def incidents_by_weather(incidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Incidents and affected customers per vigilance level of their region and day."""
    conditions = weather.select(F.col("date_mesure").alias("_day"), "region", "vigilance_meteo")
    joined = incidents.withColumn("_day", F.to_date("date_debut_incident")).join(conditions, ["_day", "region"], "left")
    return joined.groupBy(F.coalesce("vigilance_meteo", F.lit("VERTE")).alias("vigilance_meteo")).agg(
        F.count(F.lit(1)).alias("nb_incidents"), F.sum("nb_clients_affectes").alias("nb_clients_affectes")
    )
