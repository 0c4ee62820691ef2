"""The layered batch: raw tables → cleaned tables → enriched tables and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridvoice.operators import cleaning, enrich, kpi, quality
from gridvoice.sources import readers, sinks
from gridvoice.sources.schemas import layer_path

CLEANERS = {
    "reclamations": ("reclamations_cleaned", cleaning.clean_complaints, ["region"]),
    "compteurs_linky": ("compteurs_verified", cleaning.clean_meters, ["region"]),
    "factures": ("factures_validated", cleaning.clean_invoices, []),
}


def clean(spark: SparkSession, root: str) -> list[str]:
    """Clean every raw table that exists; returns the written paths."""
    written = []
    for raw, (name, cleaner, partitions) in CLEANERS.items():
        df = readers.optional_parquet(spark, layer_path(root, "bronze", raw))
        if df is None:
            continue
        path = layer_path(root, "silver", name)
        sinks.write_parquet(cleaner(df), path, partitions)
        written.append(path)
    return written


def enriched(cleaned: DataFrame, as_of: str) -> DataFrame:
    return enrich.with_recurrence(enrich.with_priority_score(enrich.with_day_durations(cleaned, as_of)))


def publish(spark: SparkSession, root: str, as_of: str, quality_threshold: float | None = None) -> dict[str, str]:
    """Gate on the real quality score, then write the enriched complaints, daily KPIs and region analytics."""
    cleaned = readers.read_parquet(spark, layer_path(root, "silver", "reclamations_cleaned"))
    if quality_threshold is not None:
        quality.enforce(quality.overall(cleaned), "score_global", quality_threshold)
    paths = {name: layer_path(root, "gold", name) for name in ("reclamations_enriched", "kpis_daily", "analytics_by_region")}
    sinks.write_parquet(enriched(cleaned, as_of), paths["reclamations_enriched"], ["region", "type_reclamation"])
    # Both aggregates read the written table, so the enrichment runs once.
    table = readers.read_parquet(spark, paths["reclamations_enriched"])
    sinks.write_snapshot(kpi.gold_daily(table, as_of), paths["kpis_daily"], "date_calcul")
    sinks.write_snapshot(kpi.region_analytics(table, as_of), paths["analytics_by_region"], "date_snapshot")
    return paths
