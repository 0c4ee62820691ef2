"""Statistical anomalies on volumes, durations, duplicates and missing regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions.skew import exact_quantiles

# Fixed order of severities in reports.
SEVERITY_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def daily_counts(df: DataFrame, key: str = "region") -> DataFrame:
    return df.groupBy(key, F.to_date("date_creation").alias("date")).agg(F.count(F.lit(1)).alias("nb_reclamations"))


def with_mean_and_deviation(daily: DataFrame, key: str = "region") -> DataFrame:
    """Mean and sample deviation of the daily counts on each day.

    There is one row per key and day, so the window's groups are bounded by the
    number of days and the complaints are scanned only once.
    """
    group = W.partitionBy(key)
    return daily.withColumns(
        {"moyenne": F.avg("nb_reclamations").over(group), "ecart_type": F.stddev("nb_reclamations").over(group)}
    )


def with_z_score(df: DataFrame) -> DataFrame:
    """Null when the deviation is null or zero."""
    return df.withColumn("z_score", F.try_divide(F.col("nb_reclamations") - F.col("moyenne"), F.col("ecart_type")))


def volume_outliers(df: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Region-days whose count is more than ``threshold`` deviations from the region's mean."""
    scored = with_z_score(with_mean_and_deviation(daily_counts(df)))
    return scored.filter(F.abs("z_score") > threshold)


def labelled(outliers: DataFrame) -> DataFrame:
    """Kind, severity and text of each statistical anomaly."""
    z = F.col("z_score")
    return outliers.select(
        "region",
        "date",
        F.when(z > 0, "PIC_RECLAMATIONS").otherwise("BAISSE_RECLAMATIONS").alias("type_anomalie"),
        F.lit("nombre_reclamations_quotidiennes").alias("metrique"),
        F.col("nb_reclamations").cast("double").alias("valeur_observee"),
        F.col("moyenne").alias("valeur_moyenne_historique"),
        F.coalesce("ecart_type", F.lit(0.0)).alias("ecart_type_historique"),
        "z_score",
        F.when(F.abs(z) > 3, "CRITIQUE").otherwise("HAUTE").alias("severite"),
        F.format_string(
            "Volume inhabituel: %d réclamations (moyenne: %.0f, écart: %.2fσ)", "nb_reclamations", "moyenne", z
        ).alias("description"),
    )


def by_distance(outliers: DataFrame) -> DataFrame:
    return outliers.orderBy(F.abs("z_score").desc(), "region", "date")


def _row(kind: str, severity: Column, table: str, field: str, text: Column, affected: Column, run_date: str) -> list[Column]:
    """The common anomaly record."""
    return [
        F.lit(run_date).cast("date").alias("detection_date"),
        F.lit(kind).alias("anomaly_type"),
        severity.alias("severity"),
        F.lit(table).alias("table_name"),
        F.lit(field).alias("field_name"),
        text.alias("description"),
        affected.cast("long").alias("count_affected"),
    ]


def type_volume_shift(kpis: DataFrame, run_date: str) -> DataFrame:
    """Types whose volume of the day leaves mean ± 2σ of days D−8 to D−1."""
    run = F.lit(run_date).cast("date")
    volume = F.sum(F.col("nombre_ouvertes") + F.col("nombre_cloturees"))
    baseline = (
        kpis.filter(F.col("date_calcul").between(F.date_sub(run, 8), F.date_sub(run, 1)))
        .groupBy("date_calcul", "type_reclamation")
        .agg(volume.alias("total"))
        .groupBy("type_reclamation")
        .agg(F.avg("total").alias("avg_total"), F.stddev("total").alias("std_total"))
    )
    today = kpis.filter(F.col("date_calcul") == run).groupBy("type_reclamation").agg(volume.alias("total_today"))
    gap = F.abs(F.col("total_today") - F.col("avg_total"))
    deviation = F.nullif(F.col("std_total"), F.lit(0.0))
    return (
        today.join(baseline, "type_reclamation")
        .filter(gap > 2 * deviation)
        .withColumn("z_score", gap / deviation)
    )


def type_volume_anomalies(kpis: DataFrame, run_date: str) -> DataFrame:
    z = F.col("z_score")
    direction = F.when(F.col("total_today") > F.col("avg_total"), "PIC").otherwise("CREUX")
    text = F.concat_ws(" ", F.lit("Volume"), direction, F.lit("pour"), "type_reclamation")
    return type_volume_shift(kpis, run_date).select(
        *_row(
            "VOLUME_ANOMALY",
            F.when(z > 3, "HIGH").otherwise("MEDIUM"),
            "kpis_daily",
            "nombre_reclamations",
            text,
            F.col("total_today"),
            run_date,
        )
    )


def duration_bounds(df: DataFrame, run_date: str | None = None, days: int = 30) -> DataFrame:
    """Exact quartiles per type over the complaints created in the last ``days`` days, or over all of them."""
    recent = df.filter(F.col("duree_traitement_heures").isNotNull())
    if run_date is not None:
        recent = recent.filter(F.col("date_creation") >= F.date_sub(F.lit(run_date).cast("date"), days))
    return exact_quantiles(recent, ["type_reclamation"], "duree_traitement_heures", {"q1": 0.25, "q3": 0.75}, 1.0)


def duration_outliers(df: DataFrame, run_date: str | None = None, days: int = 30) -> DataFrame:
    """Per type: durations created on the run date above Q3 + 3·IQR, or negative.

    Without a date all complaints are checked against the quartiles of all of them.
    """
    bounds = duration_bounds(df, run_date, days).select(
        "type_reclamation", (F.col("q3") + 3 * (F.col("q3") - F.col("q1"))).alias("borne")
    )
    duration = F.col("duree_traitement_heures")
    checked = df if run_date is None else df.filter(F.to_date("date_creation") == F.lit(run_date).cast("date"))
    return (
        checked.join(bounds, "type_reclamation")
        .filter((duration > F.col("borne")) | (duration < 0))
        .groupBy("type_reclamation", "borne")
        .agg(F.count(F.lit(1)).alias("nb"), F.min(duration).alias("min_heures"), F.max(duration).alias("max_heures"))
    )


def duration_anomalies(df: DataFrame, run_date: str, days: int = 30) -> DataFrame:
    text = F.concat_ws(" ", F.lit("Durées aberrantes pour"), "type_reclamation")
    return duration_outliers(df, run_date, days).select(
        *_row(
            "DURATION_OUTLIER",
            F.when(F.col("nb") > 10, "HIGH").otherwise("MEDIUM"),
            "reclamations",
            "duree_traitement_heures",
            text,
            F.col("nb"),
            run_date,
        )
    )


def negative_durations(df: DataFrame, run_date: str | None = None) -> DataFrame:
    """Complaints closed before they were created, per type (of one day when given)."""
    rows = df.filter(F.col("duree_traitement_heures") < 0)
    if run_date is not None:
        rows = rows.filter(F.to_date("date_creation") == F.lit(run_date).cast("date"))
    return rows.groupBy("type_reclamation").agg(F.count(F.lit(1)).alias("nb"))


def negative_duration_anomalies(df: DataFrame, run_date: str) -> DataFrame:
    text = F.concat_ws(" ", F.lit("Durées négatives pour"), "type_reclamation")
    return negative_durations(df, run_date).select(
        *_row(
            "NEGATIVE_DURATION",
            F.lit("CRITICAL"),
            "reclamations",
            "duree_traitement_heures",
            text,
            F.col("nb"),
            run_date,
        )
    )


def duplicate_groups(df: DataFrame, run_date: str | None = None) -> DataFrame:
    """Several complaints of the same client and type on one day."""
    jour = F.to_date("date_creation")
    rows = df if run_date is None else df.filter(jour == F.lit(run_date).cast("date"))
    return (
        rows.groupBy("client_id", "type_reclamation", jour.alias("creation_day"))
        .agg(F.count(F.lit(1)).alias("nb_reclamations"))
        .filter(F.col("nb_reclamations") > 1)
    )


def duplicate_anomalies(df: DataFrame, run_date: str) -> DataFrame:
    """One record summing up the duplicate groups of the day, none when there are no groups."""
    summary = duplicate_groups(df, run_date).agg(
        F.count(F.lit(1)).alias("_groups"), F.sum("nb_reclamations").alias("_rows")
    )
    text = F.concat_ws(" ", F.col("_groups").cast("string"), F.lit("groupes de doublons potentiels"))
    return summary.filter(F.col("_groups") > 0).select(
        *_row(
            "POTENTIAL_DUPLICATES",
            F.when(F.col("_groups") > 50, "HIGH").otherwise("MEDIUM"),
            "reclamations",
            "client_id + type_reclamation",
            text,
            F.col("_rows"),
            run_date,
        )
    )


def missing_regions(kpis: DataFrame, run_date: str) -> DataFrame:
    """Regions seen in the seven days before and absent on the day."""
    run = F.lit(run_date).cast("date")
    usual = kpis.filter(F.col("date_calcul").between(F.date_sub(run, 7), F.date_sub(run, 1))).select("region").distinct()
    today = kpis.filter(F.col("date_calcul") == run).select("region")
    return usual.join(today, "region", "left_anti")


def missing_regions_by_difference(kpis: DataFrame, run_date: str) -> DataFrame:
    """The same set, written as a set difference."""
    run = F.lit(run_date).cast("date")
    usual = kpis.filter(F.col("date_calcul").between(F.date_sub(run, 7), F.date_sub(run, 1))).select("region")
    return usual.subtract(kpis.filter(F.col("date_calcul") == run).select("region"))


def missing_region_anomalies(kpis: DataFrame, run_date: str) -> DataFrame:
    count = missing_regions(kpis, run_date).agg(F.count(F.lit(1)).alias("_n"))
    return count.filter(F.col("_n") > 0).select(
        *_row(
            "MISSING_REGION_DATA",
            F.lit("MEDIUM"),
            "kpis_daily",
            "region",
            F.lit("Régions sans données aujourd'hui"),
            F.col("_n"),
            run_date,
        )
    )


def all_anomalies(complaints: DataFrame, kpis: DataFrame, run_date: str) -> DataFrame:
    """Bag union of the volume, duration, duplicate and geography detectors."""
    parts = [
        type_volume_anomalies(kpis, run_date),
        duration_anomalies(complaints, run_date),
        negative_duration_anomalies(complaints, run_date),
        duplicate_anomalies(complaints, run_date),
        missing_region_anomalies(kpis, run_date),
    ]
    return reduce(DataFrame.unionByName, parts)


def severity_rank(column: str = "severity", order: list[str] | None = None) -> Column:
    levels = order or SEVERITY_ORDER
    return C.case(column, {level: i + 1 for i, level in enumerate(levels)}, len(levels) + 1)


def report(anomalies: DataFrame) -> DataFrame:
    """Occurrences and affected rows per type and severity, gravest first."""
    return (
        anomalies.groupBy("anomaly_type", "severity")
        .agg(F.count(F.lit(1)).alias("nb"), F.sum("count_affected").alias("total_affected"))
        .orderBy(severity_rank(), "anomaly_type")
    )


def seven_day_peaks(
    df: DataFrame, volume: str = "nb_reclamations_zone_jour", zone: str = "region", days: int = 7
) -> DataFrame:
    """Rolling mean and deviation of the zone-day volume over the rows of the last ``days`` days.

    The volume is the number of rows of the zone and day, unless ``df`` has it already.

    The frame is a range of seconds over all rows of a zone. Rows are first counted
    per zone and second, then each second is laid on its own period and the next
    one: a period and its predecessor cover every frame, so the window runs per
    (zone, period) instead of one task per zone. The figures of a frame are a running total less
    the running total before the frame begins, which is read at an empty row added there, so the cost is linear.
    """
    span = days * 86400
    second = F.unix_timestamp("date_creation")
    if volume in df.columns:
        per_second = df.groupBy(zone, second.alias("_s"), F.col(volume).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    else:
        per_second = df.groupBy(zone, second.alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
        # At most one row per second of the day in a group.
        of_day = W.partitionBy(zone, F.floor(F.col("_s") / 86400))
        per_second = per_second.withColumn("_v", F.sum("_n").over(of_day))
    per_second = per_second.withColumn("_p", F.floor(F.col("_s") / span))
    laid = per_second.withColumn("_part", F.explode(F.array(F.col("_p"), F.col("_p") + 1)))
    # odd places are rows, even ones the instants just before a frame begins
    rows = laid.select(zone, "_part", "_s", (F.col("_s") * 2 + 1).alias("_o"), (F.col("_part") == F.col("_p")).alias("_own"), "_n", "_v")
    begins = per_second.select(
        zone,
        F.col("_p").alias("_part"),
        "_s",
        ((F.col("_s") - span) * 2).alias("_o"),
        F.lit(True).alias("_own"),
        F.lit(0).cast("long").alias("_n"),
        F.lit(None).cast("long").alias("_v"),
    ).distinct()
    upto = W.partitionBy(zone, "_part").orderBy("_o").rangeBetween(W.unboundedPreceding, 0)
    volume_or_0 = F.coalesce(F.col("_v"), F.lit(0))
    running = {
        "_cn": F.sum("_n").over(upto),
        "_ct": F.sum(F.col("_n") * volume_or_0).over(upto),
        "_cq": F.sum(F.col("_n") * volume_or_0 * volume_or_0).over(upto),
    }
    is_row = F.col("_o") % 2 != 0

    def within_frame(name: str) -> Column:
        return (F.max(F.when(is_row, F.col(name))) - F.max(F.when(~is_row, F.col(name)))).alias(name)

    stats = (
        rows.unionByName(begins)
        .withColumns(running)
        .filter("_own")
        .groupBy(F.col(zone).alias("_zone"), F.col("_s").alias("_at"))
        .agg(*[within_frame(c) for c in running], F.max("_v").alias("_vol"))
        .select(
            "_zone",
            "_at",
            "_vol",
            (F.col("_ct") / F.col("_cn")).alias("moyenne_7j"),
            F.sqrt(
                F.greatest(
                    F.try_divide(F.col("_cq") - F.col("_ct") * (F.col("_ct") / F.col("_cn")), F.col("_cn") - 1),
                    F.when(F.col("_cn") > 1, 0.0),
                )
            ).alias("ecart_type_7j"),
        )
    )
    on = df[zone].eqNullSafe(F.col("_zone")) & (second == F.col("_at"))
    if volume in df.columns:
        joined = df.join(stats, on).drop("_zone", "_at", "_vol")
    else:
        joined = df.join(stats, on).drop("_zone", "_at").withColumnRenamed("_vol", volume)
    peak = F.col(volume) > F.col("moyenne_7j") + 2 * F.col("ecart_type_7j")
    return joined.withColumn("est_anomalie_statistique", F.coalesce(peak, F.lit(False)))
