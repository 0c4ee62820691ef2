"""Reusable column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridvoice.functions import domains as D

KM_PER_DEGREE = 111.0
EARTH_RADIUS_KM = 6371.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case(value: str | Column, mapping: Mapping, default=None) -> Column:
    """``CASE value WHEN k THEN v … ELSE default`` from a small fixed mapping.

    A literal CASE keeps five-row dimensions out of the join graph altogether.
    """
    value = col(value)
    out = None
    for key, result in mapping.items():
        out = F.when(value == key, F.lit(result)) if out is None else out.when(value == key, F.lit(result))
    return out.otherwise(F.lit(default))


def banded(value: str | Column, bands: Iterable[tuple[float, str]], default: str) -> Column:
    """Label of the first band whose lower bound the value reaches."""
    value = col(value)
    out = None
    for bound, label in bands:
        out = F.when(value >= bound, label) if out is None else out.when(value >= bound, label)
    return out.otherwise(default)


def moment(at: str | Column) -> Column:
    """A point in time given as text or as a column."""
    return F.lit(at).cast("timestamp") if isinstance(at, str) else at


def day(at: str | Column) -> Column:
    return F.to_date(moment(at))


def hours_between(end: str | Column, start: str | Column) -> Column:
    """Elapsed hours in whole seconds; null when either side is null."""
    return (F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / 3600


def is_open(status: str | Column = "statut") -> Column:
    return col(status).isin(D.OPEN_STATUSES)


def sla_limit(kind: str | Column = "type_reclamation", default: int | None = D.SLA_DEFAULT) -> Column:
    return case(kind, D.SLA_HOURS, default).cast("int")


def rate(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``scale * part / whole``, null when the whole is zero or null."""
    return F.try_divide(F.lit(scale) * part, whole)


def rounded(value: str | Column, digits: int) -> Column:
    """Half-up rounding of the decimal value, so a figure computed as 57.50499999… rounds like 57.505."""
    return F.round(col(value).cast("decimal(28,8)"), digits).cast("double")


def exact_avg(value: str | Column, digits: int) -> Column:
    """Mean of already rounded figures, computed in decimals and rounded half up."""
    return F.round(F.avg(col(value).cast("decimal(20,6)")), digits).cast("double")


def evolution(current: Column, previous: Column) -> Column:
    """Percentage change, null unless the base is positive."""
    return F.when(previous > 0, F.lit(100.0) * (current - previous) / previous)


def flat_distance_km(lat1, lon1, lat2, lon2) -> Column:
    """Straight line in degrees times 111: cheap, and what the linkage rule uses."""
    dlat, dlon = col(lat1) - col(lat2), col(lon1) - col(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon) * KM_PER_DEGREE


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance on a sphere."""
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(half))


def zero_padded(text: Column, width: int) -> Column:
    """``text`` with leading zeros up to ``width`` characters; longer text is not cut."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
