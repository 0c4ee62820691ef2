"""Distinct clients and medians of any period from mergeable sketches kept on the daily rows.

An average of daily distinct counts or medians says nothing about the week. A sketch does: HyperLogLog for the clients and KLL for the
durations are stored once a day and merged into weeks, months or any other set of days, without the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the HyperLogLog buckets; one standard error is 1.04 / sqrt(2 ** LG_K).
LG_K = 12
#: Size of a KLL sketch; ranks are within RANK_ERROR with a confidence of 99 %.
KLL_K = 400
RANK_ERROR = 0.01
#: Four standard errors of the number of clients.
CLIENT_ERROR = 4 * 1.04 / 2 ** (LG_K / 2)

KEYS = ("region", "type_reclamation")


def daily(rows: DataFrame, keys: Sequence[str] = KEYS, duration: str = "duree_traitement_heures") -> DataFrame:
    """One row per day and key with the counts and the two sketches. Rows without a duration count, but not in the median."""
    return rows.groupBy(F.to_date("date_creation").alias("date_calcul"), *keys).agg(
        F.count(F.lit(1)).alias("nombre_reclamations_total"),
        F.count(duration).alias("nb_durees"),
        F.hll_sketch_agg("client_id", LG_K).alias("clients"),
        F.kll_sketch_agg_double(F.col(duration).cast("double"), F.lit(KLL_K)).alias("durees"),
    )


def merged(sketches: DataFrame, period: Column, name: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The sketches of one period, from those of days or of shorter periods. Order and grouping of the merges do not matter."""
    return sketches.groupBy(period.alias(name), *keys).agg(
        F.sum("nombre_reclamations_total").alias("nombre_reclamations_total"),
        F.sum("nb_durees").alias("nb_durees"),
        F.hll_union_agg("clients").alias("clients"),
        F.kll_merge_agg_double("durees").alias("durees"),
    )


def weekly(sketches: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return merged(sketches, F.trunc("date_calcul", "week"), "debut_semaine", keys)


def monthly(sketches: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return merged(sketches, F.trunc("date_calcul", "month"), "debut_mois", keys)


def estimates(sketches: DataFrame) -> DataFrame:
    """Distinct clients and median duration read from the sketches; no median without durations."""
    median = F.when(F.col("nb_durees") > 0, F.kll_sketch_get_quantile_double("durees", F.lit(0.5)))
    # united with itself a sketch is read from its registers alone; else the estimate also depends on the order of the merges
    clients = F.hll_sketch_estimate(F.hll_union("clients", "clients"))
    return sketches.withColumns({"nb_clients": clients, "duree_mediane": median}).drop("clients", "durees")


def against_rows(
    found: DataFrame, rows: DataFrame, period: Column, name: str, keys: Sequence[str] = KEYS, duration: str = "duree_traitement_heures"
) -> DataFrame:
    """Are the estimates of a period within their bounds? Compared with the distinct clients and the ranks in the raw rows."""
    by = [name, *keys]
    dated = rows.select(period.alias(name), *keys, "client_id", F.col(duration).alias("_d"))
    # a distinct count beside other aggregates would expand the rows
    exact = dated.groupBy(*by, "client_id").agg(F.lit(1)).groupBy(*by).agg(F.count(F.lit(1)).alias("nb_clients_exact"))
    ranks = dated.join(found.select(*by, "duree_mediane"), by).groupBy(*by).agg(
        F.count_if(F.col("_d") < F.col("duree_mediane")).alias("_below"), F.count_if(F.col("_d") <= F.col("duree_mediane")).alias("_upto")
    )
    n, half = F.col("nb_durees"), 0.5 * F.col("nb_durees")
    slack = F.greatest(F.lit(1.0), RANK_ERROR * n)
    close = F.abs(F.col("nb_clients") - F.col("nb_clients_exact")) <= F.greatest(F.lit(0.5), CLIENT_ERROR * F.col("nb_clients_exact"))
    right = (n == 0) | ((F.col("_below") <= half + slack) & (F.col("_upto") >= half - slack))
    return (
        found.join(exact, by)
        .join(ranks, by)
        .select(*by, "nombre_reclamations_total", "nb_durees", "nb_clients_exact", close.alias("clients_juste"), right.alias("mediane_juste"))
    )
