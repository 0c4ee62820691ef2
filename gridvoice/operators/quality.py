"""Data-quality scores. Each score is one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.operators import cleaning


class QualityError(ValueError):
    """Raised by :func:`enforce` when a score is under its threshold."""


def _n() -> Column:
    return F.count(F.lit(1))


def _share(bad: Column, of: Column) -> Column:
    return F.coalesce(C.rounded((1 - F.try_divide(bad.cast("double"), of)) * 100, 2), F.lit(100.0))


def _missing(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    return reduce(lambda a, b: a + b, [F.count_if(_missing(f)) for f in fields])


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of filled cells among ``columns`` (all columns by default)."""
    width = len([c for c in df.columns if columns is None or c in columns])
    return df.agg(
        _n().alias("total"),
        missing_cells(df, columns).alias("total_nulls"),
        _share(missing_cells(df, columns), _n() * width).alias("score"),
    )


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; all null keys together count as one key.

    Counted through a per-key aggregation, which the map side reduces first.
    """
    per_key = df.groupBy(key).agg(_n().alias("_n"))
    return per_key.agg(F.sum("_n").alias("total"), F.sum(F.col("_n") - 1).alias("duplicates"))


def uniqueness(df: DataFrame, key: str = "id_reclamation") -> DataFrame:
    return duplicate_rows(df, key).select(
        "total", "duplicates", _share(F.col("duplicates"), F.col("total")).alias("score")
    )


def _outside(column: str, allowed: Sequence) -> Column:
    return F.count_if(F.coalesce(~F.col(column).isin(*allowed), F.lit(True)))


def validity(df: DataFrame) -> DataFrame:
    """Complaint type, status and priority inside their domains; null is invalid."""
    kinds = _outside("type_reclamation", D.TYPES)
    statuses = _outside("statut", D.STATUSES)
    priorities = _outside("priorite", D.PRIORITIES)
    return df.agg(
        kinds.alias("types_invalides"),
        statuses.alias("statuts_invalides"),
        priorities.alias("priorites_invalides"),
        _share(kinds + statuses + priorities, _n() * 3).alias("score"),
    )


def consistency(df: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("date_cloture") < F.col("date_creation"))
    return df.agg(bad.alias("incoherentes"), _share(bad, _n()).alias("score"))


def overall(df: DataFrame, key: str = "id_reclamation") -> DataFrame:
    """The four scores, their weighted sum and the pass mark, as one row.

    One scan: figures are summed per key (merged on the map side) and then over the
    keys, where the rows beyond the first of a key are the duplicates.
    """
    columns = D.REQUIRED_COLUMNS
    invalid = (
        _outside("type_reclamation", D.TYPES) + _outside("statut", D.STATUSES) + _outside("priorite", D.PRIORITIES)
    )
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        _n().alias("_n"),
        missing_cells(df, columns).alias("_nulls"),
        invalid.alias("_invalid"),
        F.count_if(F.col("date_cloture") < F.col("date_creation")).alias("_late"),
    )
    rows = F.sum("_n")
    parts = per_key.agg(
        rows.alias("total"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
        _share(F.sum("_nulls"), rows * len(columns)).alias("completude"),
        _share(F.sum(F.col("_n") - 1), rows).alias("unicite"),
        _share(F.sum("_invalid"), rows * 3).alias("validite"),
        _share(F.sum("_late"), rows).alias("coherence"),
    )
    total = reduce(lambda a, b: a + b, [F.col(k) * w for k, w in D.QUALITY_WEIGHTS.items()])
    return parts.withColumn("score_global", C.rounded(total, 2)).withColumn(
        "accepte", F.col("score_global") >= D.QUALITY_PASS
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, from a single scan."""
    counts = df.agg(_n().alias("_total"), *[F.count_if(_missing(f)).alias(f.name) for f in df.schema.fields])
    pairs = F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(f"`{c}`").alias("nb")) for c in df.columns])
    return counts.select("_total", F.explode(pairs).alias("p")).select(
        F.col("p.colonne").alias("colonne"),
        F.col("p.nb").alias("nb_nulls"),
        C.rounded(F.try_divide(F.col("p.nb") * 100.0, F.col("_total")), 2).alias("pct_nulls"),
    )


def meter_validity(meters: DataFrame) -> DataFrame:
    bad_ref = F.count_if(~F.col("reference_linky").rlike(D.METER_REFERENCE))
    bad_power = F.count_if(~F.col("puissance_souscrite_kva").isin(*D.METER_POWERS))
    return meters.agg(
        _n().alias("total"),
        bad_ref.alias("references_invalides"),
        bad_power.alias("puissances_invalides"),
        _share(bad_ref + bad_power, _n()).alias("score"),
    )


def invoice_consistency(invoices: DataFrame) -> DataFrame:
    amounts = F.count_if(~cleaning.amounts_agree())
    dates = F.count_if(F.col("date_echeance") < F.col("date_emission"))
    return invoices.agg(
        _n().alias("total"),
        amounts.alias("montants_incoherents"),
        dates.alias("dates_incoherentes"),
        _share(amounts + dates, _n()).alias("score"),
    )


def recent_average(metrics: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    """Mean score of the checks of the last ``hours``; 100 when there is none."""
    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return metrics.filter(F.col("execution_date") >= since).agg(
        F.coalesce(F.avg("overall_quality_score"), F.lit(100.0)).alias("score_moyen")
    )


def gate(score: Column, threshold: float) -> Column:
    return score >= threshold


def enforce(scores: DataFrame, column: str, threshold: float) -> float:
    """Stop the job when the single score is under the threshold. ``scores`` has one row."""
    value = scores.first()[column]
    if value is None or value < threshold:
        raise QualityError(f"{column} = {value} is under {threshold}")
    return float(value)


def layer_gate(df: DataFrame, layer: str, key: str = "id_reclamation") -> DataFrame:
    """Compare the measured scores with the thresholds of a layer, one row per measure."""
    measured = overall(df, key)
    names = {"completeness": "completude", "validity": "validite", "consistency": "coherence", "uniqueness": "unicite"}
    rows = F.array(
        *[
            F.struct(
                F.lit(measure).alias("mesure"),
                F.col(names[measure]).alias("score"),
                F.lit(bound * 100.0).alias("seuil"),
            )
            for measure, bound in D.LAYER_THRESHOLDS[layer].items()
            if measure in names
        ]
    )
    return measured.select(F.explode(rows).alias("r")).select(
        "r.mesure", "r.score", "r.seuil", gate(F.col("r.score"), F.col("r.seuil")).alias("accepte")
    )


@dataclass(frozen=True)
class Expectation:
    """A named rule: ``violated`` is true on rows that break it."""

    name: str
    violated: Column


def not_null(column: str) -> Expectation:
    return Expectation(f"{column}: non nul", F.col(column).isNull())


def in_set(column: str, allowed: Sequence) -> Expectation:
    return Expectation(f"{column}: domaine", F.coalesce(~F.col(column).isin(*allowed), F.lit(False)))


def matches(column: str, pattern: str) -> Expectation:
    return Expectation(f"{column}: format", F.coalesce(~F.col(column).rlike(pattern), F.lit(False)))


def between(column: str, low, high) -> Expectation:
    return Expectation(f"{column}: intervalle", F.coalesce(~F.col(column).between(low, high), F.lit(False)))


def ordered(earlier: str, later: str) -> Expectation:
    return Expectation(f"{later} >= {earlier}", F.coalesce(F.col(later) < F.col(earlier), F.lit(False)))


def expectations(df: DataFrame, rules: Sequence[Expectation], unique: Sequence[str] = ()) -> DataFrame:
    """Evaluate all row rules in one scan, uniqueness rules through one aggregation each."""
    row = df.agg(*[F.count_if(r.violated).alias(f"r{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("regle"), F.col(f"r{i}").alias("nb")) for i, r in enumerate(rules)])
    result = row.select(F.explode(pairs).alias("p")).select("p.regle", F.col("p.nb").alias("nb_violations"))
    for key in unique:
        result = result.unionByName(
            duplicate_rows(df, key).select(F.lit(f"{key}: unicite").alias("regle"), F.col("duplicates").alias("nb_violations"))
        )
    return result.withColumn("respectee", F.col("nb_violations") == 0)
