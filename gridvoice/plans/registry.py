"""Registry of the published queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice.sources.conform import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 4):
    """Register ``fn(tables) -> DataFrame`` under ``name``.

    ``sql`` is the equivalent query; without it only the row count can be checked.
    """

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, directory: presentable(fn(Tables(spark, directory)), digits)
        if sql is not None:
            _SQL[name] = sql
        return fn

    return wrap


def oracles() -> dict[str, str]:
    """SQL twins with the domain views they use."""
    return {name: with_views(sql) for name, sql in _SQL.items()}


def presentable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles and print dates and times, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            # adding 0.0 turns a rounded negative zero into zero
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)
