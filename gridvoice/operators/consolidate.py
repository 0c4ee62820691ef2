"""One table of all complaints: base columns, specialised overrides, cross-type figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D

OVERRIDDEN = ("sla_respect", "risque_depassement", "heures_restantes")


def base(complaints: DataFrame, run_date: str, source: str = "base") -> DataFrame:
    """Base rows. ``duree_heures`` is the closed duration; an unknown type never breaches."""
    limit = C.sla_limit(default=D.SLA_UNKNOWN)
    closed = F.col("date_cloture").isNotNull()
    return complaints.select(
        "id_reclamation",
        "client_id",
        "region",
        "departement",
        "type_reclamation",
        "statut",
        "priorite",
        "date_creation",
        "date_cloture",
        F.col("duree_traitement_heures").alias("duree_heures"),
        C.sla_limit(default=None).alias("sla_heures"),
        F.when(closed, F.col("duree_traitement_heures") <= limit).alias("sla_respect"),
        F.lit(False).alias("risque_depassement"),
        F.lit(None).cast("double").alias("heures_restantes"),
        F.lit(source).alias("source"),
        F.lit(run_date).cast("date").alias("export_date"),
    )


def override(target: DataFrame, detail: DataFrame, keys: Sequence[str], columns: Sequence[str], **constants) -> DataFrame:
    """Take ``columns`` from the matching detail row, nulls included; other rows stay as they are.

    Matches are recognised by a marker column, because a detail value may itself be
    null. ``detail`` must be unique on ``keys``.
    """
    renamed = detail.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns]).withColumn("_matched", F.lit(True))
    joined = target.join(renamed, list(keys), "left")
    matched = F.col("_matched").isNotNull()
    out = []
    for c in target.columns:
        if c in columns:
            out.append(F.when(matched, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in constants:
            out.append(F.when(matched, F.lit(constants[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def consolidate(complaints: DataFrame, details: DataFrame | Mapping[str, DataFrame], run_date: str) -> DataFrame:
    """Base rows with the deadline columns of the specialised details.

    The details are one frame with a ``source`` column, or a frame per source. They hold disjoint complaint types, so
    they are combined first and the wide base is joined once.
    """
    columns = list(OVERRIDDEN)
    if isinstance(details, DataFrame):
        combined = details.select("id_reclamation", *columns, "source")
    else:
        parts = [d.select("id_reclamation", *columns, F.lit(s).alias("source")) for s, d in details.items()]
        combined = reduce(DataFrame.unionByName, parts)
    return override(base(complaints, run_date), combined, ["id_reclamation"], [*columns, "source"])


def cross_type_kpis(consolidated: DataFrame, run_date: str) -> DataFrame:
    met, known = F.count_if("sla_respect"), F.count("sla_respect")
    total = F.count(F.lit(1))
    critical = F.count_if(F.col("priorite") == "CRITIQUE")
    return (
        consolidated.filter(F.col("export_date") == F.lit(run_date).cast("date"))
        .groupBy(F.coalesce("region", F.lit("INCONNUE")).alias("region"), "type_reclamation")
        .agg(
            F.count_if(C.is_open()).alias("nombre_ouvertes"),
            F.count_if(F.col("statut") == "CLOTURE").alias("nombre_cloturees"),
            C.rounded(F.avg("duree_heures"), 2).alias("duree_moyenne_traitement"),
            C.rounded(C.rate(met, known), 2).alias("taux_respect_sla"),
            critical.alias("nb_critiques"),
            C.rounded(C.rate(critical, total), 2).alias("taux_critique"),
        )
        .withColumn("date_calcul", F.lit(run_date).cast("date"))
    )


def summary(consolidated: DataFrame, run_date: str) -> DataFrame:
    late = (~F.col("sla_respect")) & F.col("date_cloture").isNotNull()
    return (
        consolidated.filter(F.col("export_date") == F.lit(run_date).cast("date"))
        .groupBy("type_reclamation")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(C.is_open()).alias("en_cours"),
            F.count_if(late).alias("hors_sla"),
            F.count_if("risque_depassement").alias("en_risque"),
            C.rounded(F.avg("duree_heures"), 1).alias("duree_moy_h"),
        )
        .orderBy(F.desc("total"), "type_reclamation")
    )


def active_complaints(consolidated: DataFrame) -> DataFrame:
    """Open complaints of the latest export, to be labelled with their alert level."""
    latest = consolidated.agg(F.max("export_date").alias("_latest"))
    return (
        consolidated.filter(C.is_open())
        .join(F.broadcast(latest), F.col("export_date") == F.col("_latest"))
        .drop("_latest")
    )
