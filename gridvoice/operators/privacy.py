"""Erasure requests, retention and archiving."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions.skew import broadcast_if_small
from gridvoice.operators import enrich

DATE_PREFERENCES = ("date_creation", "export_date", "created_at", "run_date")
PENDING = ("EN_ATTENTE", "EN_COURS")


def pending_erasures(requests: DataFrame, batch: int = 100) -> DataFrame:
    """The ``batch`` erasure requests with the earliest legal deadline."""
    return (
        requests.filter((F.col("type_demande") == "OUBLI") & F.col("statut").isin(*PENDING))
        .orderBy("date_limite_legal", "id")
        .limit(batch)
    )


def pseudonym(client: str | Column, run_date: str) -> Column:
    """``SUPPRIME_`` and the first twelve hex digits of a salted SHA-256.

    Twelve digits are the published format: 48 bits, so from some 16 million erased clients two are likely to share one.
    """
    client = F.col(client) if isinstance(client, str) else client
    digest = F.sha2(F.concat(client.cast("string"), F.lit(f"_rgpd_{run_date}")), 256)
    return F.concat(F.lit("SUPPRIME_"), F.substring(digest, 1, 12))


def _subjects(requests: DataFrame) -> DataFrame:
    """Clients to erase, each once (a client may have asked several times)."""
    return requests.select(F.col("client_id").alias("_subject")).distinct()


def pseudonymise(df: DataFrame, requests: DataFrame, run_date: str) -> DataFrame:
    """Replace the client id of requested clients; the id column becomes text."""
    joined = df.join(_subjects(requests), F.col("client_id") == F.col("_subject"), "left")
    value = F.when(F.col("_subject").isNotNull(), pseudonym("client_id", run_date)).otherwise(
        F.col("client_id").cast("string")
    )
    return joined.select(*[value.alias(c) if c == "client_id" else F.col(c) for c in df.columns])


def erasure_audit(tables: Mapping[str, DataFrame], requests: DataFrame) -> DataFrame:
    """Touched rows and tables per request. Tables without a client id are skipped.

    Each table is first narrowed to the clients asked for, so only their rows are counted and moved.
    The list holds table names, so its length is bounded by the number of tables.
    """
    asked = broadcast_if_small(requests.select("client_id").distinct())
    counts = [
        df.join(asked, "client_id", "left_semi").groupBy("client_id").agg(F.count(F.lit(1)).alias("_n")).withColumn("_table", F.lit(name))
        for name, df in tables.items()
        if "client_id" in df.columns
    ]
    touched = reduce(DataFrame.unionByName, counts)
    return (
        requests.select("id", "client_id")
        .join(touched, "client_id", "left")
        .groupBy("id", "client_id")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("nb_lignes"),
            F.sort_array(F.collect_set("_table")).alias("tables_impactees"),
        )
    )


def cutoff(as_of: str, days: int | None = None, months: int | None = None) -> Column:
    at = F.lit(as_of).cast("date")
    return F.add_months(at, -months) if months is not None else F.date_sub(at, days)


def expired(date_column: str, as_of: str, days: int | None = None, months: int | None = None) -> Column:
    return F.col(date_column) < cutoff(as_of, days, months)


def retained(df: DataFrame, date_column: str, as_of: str, days: int | None = None, months: int | None = None) -> DataFrame:
    """Rows to keep; rows without a date are kept."""
    return df.filter(F.coalesce(~expired(date_column, as_of, days, months), F.lit(True)))


def retention_overruns(
    tables: Mapping[str, DataFrame], policy: Mapping[str, int], as_of: str, preferences: Sequence[str] = DATE_PREFERENCES
) -> DataFrame:
    """Rows past their retention per table. Tables without a date column are skipped."""
    parts = []
    for name, df in tables.items():
        column = enrich.first_available(df, preferences)
        if column is None:
            continue
        days = policy[name]
        parts.append(
            df.agg(F.count_if(expired(column, as_of, days)).alias("nb_lignes")).select(
                F.lit(name).alias("table_cible"), F.lit(days).alias("retention_jours"), "nb_lignes"
            )
        )
    result = reduce(DataFrame.unionByName, parts)
    return result.withColumn("statut", F.when(F.col("nb_lignes") > 0, "ALERTE").otherwise("OK"))


def split_archive(df: DataFrame, date_column: str, as_of: str, months: int = 12) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows to keep): together exactly the input."""
    old = F.coalesce(expired(date_column, as_of, months=months), F.lit(False))
    return df.filter(old), df.filter(~old)


def archive_check(before: DataFrame, archived: DataFrame, after: DataFrame) -> DataFrame:
    """Copied rows against rows gone from the table, each counted in what is really stored."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(*[(F.col("n") if k == i else F.lit(0)).alias(f"_{k}") for k in range(3)])
        for i, df in enumerate((before, archived, after))
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in range(3)])
        .select(
            F.col("_1").alias("archivees"),
            (F.col("_0") - F.col("_2")).alias("supprimees"),
            F.col("_2").alias("conservees"),
            (F.col("_1") == F.col("_0") - F.col("_2")).alias("coherent"),
        )
    )


def overdue_requests(requests: DataFrame, as_of: str) -> DataFrame:
    late = ~F.col("statut").isin("TRAITE", "REJETE") & (F.col("date_limite_legal") < F.lit(as_of).cast("date"))
    return requests.filter(late).groupBy("type_demande").agg(F.count(F.lit(1)).alias("nb"))


def status_report(requests: DataFrame) -> DataFrame:
    return (
        requests.groupBy("type_demande", "statut")
        .agg(F.count(F.lit(1)).alias("nb"))
        .orderBy("type_demande", "statut")
    )
