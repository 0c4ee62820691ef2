"""Row-level enrichment of complaints: durations, scores, flags, labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.functions.skew import attach_group_stats
from gridvoice.sources.scratch import materialise


def with_durations(df: DataFrame) -> DataFrame:
    """Exact hours to close and to first reply; null while open or unanswered."""
    return df.withColumns(
        {
            "duree_traitement_heures": C.hours_between("date_cloture", "date_creation"),
            "delai_premiere_reponse_heures": C.hours_between("date_premiere_reponse", "date_creation"),
        }
    )


def with_elapsed(df: DataFrame, as_of: str | Column, name: str = "duree_heures") -> DataFrame:
    """Hours from creation to close, or to ``as_of`` while open."""
    return df.withColumn(name, C.hours_between(F.coalesce("date_cloture", C.moment(as_of)), "date_creation"))


def with_day_durations(df: DataFrame, as_of: str | Column) -> DataFrame:
    """Whole-day durations times 24; open complaints count up to ``as_of``."""
    end = F.coalesce(F.to_date("date_cloture"), C.day(as_of))
    return df.withColumns(
        {
            "duree_traitement_heures": F.datediff(end, "date_creation") * 24,
            "delai_premiere_reponse_heures": F.datediff("date_premiere_reponse", "date_creation") * 24,
        }
    )


def with_priority_score(df: DataFrame) -> DataFrame:
    """Base by priority, +20 while open or in progress, −10 when the first reply took over 24 h."""
    base = C.case("priorite", D.PRIORITY_SCORE, D.PRIORITY_SCORE_DEFAULT)
    still_open = F.when(C.is_open(), 20).otherwise(0)
    slow_reply = F.when(F.col("delai_premiere_reponse_heures") > 24, 10).otherwise(0)
    return df.withColumn("score_priorite", base + still_open - slow_reply)


def with_recurrence(df: DataFrame, keys: Sequence[str] = ("client_id", "type_reclamation")) -> DataFrame:
    """Number of complaints of the same client and type, and whether there are several.

    Count and join back rather than a window: a client with a huge share of the
    rows is reduced on the map side and the join can be split.
    """
    counted = attach_group_stats(df, list(keys), nombre_reclamations_client=F.count(F.lit(1)))
    return counted.withColumn("est_recurrent", F.col("nombre_reclamations_client") >= 2)


def with_group_volume(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Row count of the group on each row (zone and day volume)."""
    return attach_group_stats(df, list(keys), **{name: F.count(F.lit(1))})


def with_sequence_number(df: DataFrame, key: str, at: str, tie: str, name: str) -> DataFrame:
    """1-based rank of each row of ``key`` by time, then by ``tie``; rows equal in all three have no defined order.

    The rows are range-partitioned and sorted by (key, time, tie), so a busy key, and a busy second of it, is spread over as many tasks
    as it fills. A row's rank is its place in its partition, less the place of the key's first row there, plus the key's
    rows in earlier partitions. The sorted rows are written once: their places must not change between the two uses.
    """
    order = [key, at, tie]
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        "ranked",
    )
    per_part = placed.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(
        F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_n")
    )
    # one row per partition that has the key
    earlier = F.sum("_n").over(W.partitionBy("_k").orderBy("_p")) - F.col("_n")
    offsets = per_part.select("_k", "_p", (earlier - F.col("_start") + 1).alias("_shift"))
    joined = placed.join(offsets, (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")))
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))


def with_partition_columns(df: DataFrame, at: str = "date_creation") -> DataFrame:
    return df.withColumns({"annee": F.year(at), "mois": F.month(at)})


def with_planned_flag(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "intervention_planifiee", F.col("technicien_id").isNotNull() & F.col("date_intervention_prevue").isNotNull()
    )


def with_meter_age(df: DataFrame) -> DataFrame:
    return df.withColumn("anciennete_compteur_jours", F.datediff("date_creation", "date_installation"))


def normalise_meter_reference(ref: str | Column) -> Column:
    """Digits of the reference, left-padded to five and never cut, behind ``LINKY_``; null stays null."""
    return F.concat(F.lit("LINKY_"), C.zero_padded(F.regexp_extract(C.col(ref), "[0-9]+", 0), 5))


def repair_meter_reference(ref: str | Column, pattern: str = "^LINKY_[0-9]{5}$") -> Column:
    """Keep valid references, strip everything but digits from the others."""
    ref = C.col(ref)
    return F.when(ref.rlike(pattern), ref).otherwise(F.regexp_replace(ref, "[^0-9]", ""))


def postcode_zone(postcode: str | Column = "code_postal", zones: Iterable[tuple[str, str, str]] = tuple(D.POSTCODE_ZONES)) -> Column:
    postcode = C.col(postcode)
    out = F
    for label, low, high in zones:
        out = out.when(postcode.between(low, high), label)
    return out.otherwise("AUTRE")


def text_category(
    text: str | Column,
    fallback: str | Column,
    rules: Iterable[tuple[str, Sequence[str]]] = tuple(D.TEXT_CATEGORIES),
) -> Column:
    """First category one of whose keywords occurs in the whole lower-cased text."""
    lowered = F.lower(C.col(text))
    out = F
    for label, words in rules:
        found = lowered.contains(words[0])
        for word in words[1:]:
            found = found | lowered.contains(word)
        out = out.when(found, label)
    return out.otherwise(C.col(fallback))


def distance_to_centre(df: DataFrame, lat: float, lon: float) -> DataFrame:
    return df.withColumn("distance_centre_km", C.haversine_km("latitude", "longitude", F.lit(lat), F.lit(lon)))


def weighted_priority(
    df: DataFrame,
    as_of: str | Column,
    scores: Mapping[str, int] | None = None,
) -> DataFrame:
    """0.4 declared priority, 0.2 recurrent (30), 0.2 linked to an incident (40), 0.2 age (2 per day, at most 20)."""
    base = C.case("priorite", scores or D.PRIORITY_SCORE, D.PRIORITY_SCORE_DEFAULT)
    recurrent = F.when(F.col("est_recurrent"), 30).otherwise(0)
    linked = F.when(F.col("est_lie_incident"), 40).otherwise(0)
    age = F.least(F.datediff(C.day(as_of), "date_creation") * 2, F.lit(20))
    return df.withColumn("score_pondere", base * 0.4 + recurrent * 0.2 + linked * 0.2 + age * 0.2)


def day_period(at: str | Column = "date_creation") -> Column:
    hour = F.hour(C.col(at))
    return (
        F.when(hour.between(6, 12), "MATIN")
        .when(hour.between(12, 18), "APRES_MIDI")
        .when(hour.between(18, 22), "SOIREE")
        .otherwise("NUIT")
    )


def is_weekend(at: str | Column = "date_creation") -> Column:
    return F.dayofweek(C.col(at)).isin(1, 7)


def is_duration_outlier(days: int = 90) -> Column:
    """Closed more than ``days`` days after creation; false while open."""
    return F.coalesce(F.datediff("date_cloture", "date_creation") > days, F.lit(False))


def with_defaults(df: DataFrame, defaults: Mapping[str, str] | None = None) -> DataFrame:
    return df.fillna(dict(defaults or {"priorite": "MOYENNE", "canal": "INCONNU"}))


def first_available(df: DataFrame, preferences: Sequence[str]) -> str | None:
    """First of the preferred columns the frame has."""
    return next((c for c in preferences if c in df.columns), None)
