"""Merging new rows into an existing table, as frame-to-frame operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions.skew import first_per_key


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Insert new keys whole; on existing keys change only the ``update`` columns.

    ``source`` must be unique on ``keys``. Columns the source lacks are null on
    inserted rows. A source null overwrites.
    """
    incoming = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns]).withColumn("_s", F.lit(True))
    existing = target.withColumn("_t", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    joined = existing.join(incoming, on, "full_outer")
    has_source, has_target = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    out = []
    for f in target.schema.fields:
        new = F.col(f"_s_{f.name}") if f.name in source.columns else F.lit(None)
        new = new.cast(f.dataType)
        if f.name in keys:
            value = F.coalesce(F.col(f.name), new)
        elif f.name in update:
            value = F.when(has_source, new).otherwise(F.col(f.name))
        else:
            value = F.when(has_target, F.col(f.name)).otherwise(new)
        out.append(value.alias(f.name))
    return joined.select(*out)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows win; of several new rows with one key the smallest is kept."""
    fresh = first_per_key(source, keys).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def replace_slice(target: DataFrame, source: DataFrame, slice_: Column) -> DataFrame:
    """Drop the rows of the slice and append the new ones: running twice equals running once."""
    return target.filter(~F.coalesce(slice_, F.lit(False))).unionByName(source)


def matching_columns(df: DataFrame, target: DataFrame) -> DataFrame:
    """Keep only the columns the target has."""
    return df.select(*[c for c in df.columns if c in target.columns])


def empty_like(df: DataFrame) -> DataFrame:
    """An empty frame with the same structure."""
    return df.sparkSession.createDataFrame([], df.schema)
