"""Cleaning rules and the raw-to-clean steps of complaints, meters and invoices."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import domains as D
from gridvoice.functions.skew import first_per_key

MANDATORY = ("id_reclamation", "client_id", "type_reclamation", "date_creation")
TRIMMED = ("type_reclamation", "priorite", "statut", "canal", "region")


def require(df: DataFrame, columns: Sequence[str] = MANDATORY) -> DataFrame:
    return df.dropna(subset=[c for c in columns if c in df.columns])


def trim(df: DataFrame, columns: Sequence[str] = TRIMMED) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns if c in df.columns})


def in_order(earlier: str, later: str, keep_unknown: bool = True) -> Column:
    """``later >= earlier``; an unknown side passes when ``keep_unknown``."""
    return F.coalesce(F.col(later) >= F.col(earlier), F.lit(keep_unknown))


def consistent_dates(df: DataFrame) -> DataFrame:
    return df.filter(in_order("date_creation", "date_premiere_reponse") & in_order("date_creation", "date_cloture"))


def is_valid_reference(ref: str = "reference_linky", pattern: str = D.METER_REFERENCE) -> Column:
    return F.coalesce(F.col(ref).rlike(pattern), F.lit(False))


def null_invalid_reference(df: DataFrame, ref: str = "reference_linky", pattern: str = D.METER_REFERENCE) -> DataFrame:
    return df.withColumn(ref, F.when(F.col(ref).rlike(pattern), F.col(ref)))


def in_domain(column: str, allowed: Iterable) -> Column:
    return F.col(column).isin(*allowed)


def amounts_agree(tolerance: float = 0.01) -> Column:
    """Net plus tax equals gross within ``tolerance``, computed in decimals."""
    net, tax, gross = (F.col(c).cast("decimal(24,6)") for c in ("montant_ht", "montant_tva", "montant_ttc"))
    return F.abs(net + tax - gross) <= F.lit(tolerance).cast("decimal(10,6)")


def clean_complaints(raw: DataFrame) -> DataFrame:
    """One row per id, mandatory fields, trimmed text, coherent dates, invalid meter references nulled."""
    unique = first_per_key(require(raw), ["id_reclamation"], ["date_creation"])
    return null_invalid_reference(consistent_dates(trim(unique)))


def clean_meters(raw: DataFrame) -> DataFrame:
    valid = raw.filter(is_valid_reference() & in_domain("puissance_souscrite_kva", D.METER_POWERS))
    return first_per_key(valid, ["reference_linky"])


def clean_invoices(raw: DataFrame) -> DataFrame:
    valid = raw.filter(amounts_agree() & in_order("date_emission", "date_echeance", keep_unknown=False))
    return first_per_key(valid, ["numero_facture"])


def split_duplicates(
    df: DataFrame, group: Sequence[Column | str], at: str, identity: str
) -> tuple[DataFrame, DataFrame]:
    """(first row of each group, the other rows). ``identity`` must be unique.

    The first row is found by an aggregation and joined back, so a group with very
    many copies is never ordered in one task.
    """
    names = [f"_g{i}" for i in range(len(group))]
    keyed = df.withColumns({n: (F.col(g) if isinstance(g, str) else g) for n, g in zip(names, group)})
    first = keyed.groupBy(*names).agg(F.min(F.struct(F.col(at).alias("a"), F.col(identity).alias("i"))).alias("_f"))
    first = first.select(*[F.col(n).alias(f"{n}_k") for n in names], F.col("_f.i").alias("_first"))
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_k")) for n in names])
    marked = keyed.join(first, on).withColumn("_kept", F.col(identity) == F.col("_first"))
    extra = [*names, *[f"{n}_k" for n in names], "_first", "_kept"]
    return marked.filter("_kept").drop(*extra), marked.filter(~F.col("_kept")).drop(*extra)


def same_client_day_type(at: str = "date_creation") -> list[Column | str]:
    return ["client_id", F.to_date(at), "type_reclamation"]
