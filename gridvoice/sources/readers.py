"""Readers: CSV, Parquet, JDBC, optional tables, schema contracts, lineage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice.functions.skew import broadcast_if_small

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
PARTITION_COLUMNS = ("annee", "mois")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Headered CSV with a declared schema; without one the types are inferred."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("timestampFormat", TIMESTAMP_FORMAT).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_selected(spark: SparkSession, path: str, selection: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partitioned table whose partition is in ``selection``.

    The selection is a filtered frame that is only known when the query runs. It is broadcast if its size allows, and its keys prune the
    folders before the scan lists them (dynamic partition pruning).
    """
    wanted = selection.select(*columns).distinct()
    return spark.read.parquet(path).join(broadcast_if_small(wanted), list(columns), "left_semi")


def optional_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when the path does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def with_null_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed null columns standing in for an absent source."""
    missing = {n: F.lit(None).cast(kind) for n, kind in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Database table; split by a column range when bounds are given, else one connection reads it all."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def drop_partition_columns(df: DataFrame, columns: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """Remove physical partition columns before an export; ``region`` is data and stays."""
    return df.drop(*[c for c in columns if c in df.columns])


def with_lineage(df: DataFrame, source: str | None = None) -> DataFrame:
    """Load time and source file; the file comes from the scan unless it is named."""
    origin = F.lit(source) if source is not None else F.col("_metadata.file_name")
    return df.withColumns({"ingestion_date": F.current_timestamp(), "source_file": origin})


@dataclass
class Contract:
    name: str
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors


def check_contract(df: DataFrame, expected: T.StructType, name: str) -> Contract:
    """Empty input and missing columns fail, additional columns only warn."""
    result = Contract(name)
    have, want = set(df.columns), {f.name for f in expected.fields}
    if want - have:
        result.errors.append(f"missing columns: {sorted(want - have)}")
    if have - want:
        result.warnings.append(f"extra columns: {sorted(have - want)}")
    if df.isEmpty():
        result.errors.append("no rows")
    return result


def contract_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected or present column with its state, from the schema alone."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in sorted(have.keys() | want.keys()):
        state = "MANQUANTE" if name not in have else "SUPPLEMENTAIRE" if name not in want else "OK"
        rows.append((name, want.get(name), have.get(name), state))
    return df.sparkSession.createDataFrame(rows, "colonne string, type_attendu string, type_lu string, etat string")


def enforce_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """File sources ignore the non-null flag of a schema, so filter on it."""
    return df.dropna(subset=[f.name for f in schema.fields if not f.nullable and f.name in df.columns])


WEATHER_NUMBERS = (
    "vent_max_ms",
    "vent_rafales_ms",
    "precipitation_mm",
    "neige_cm",
    "temperature_min_c",
    "temperature_max_c",
)


def read_weather_csv(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """``;``-separated weather file: blank or malformed numbers become 0, labels get defaults."""
    rows = spark.read.option("header", True).option("sep", ";").csv(path)
    text = {"departement": "00", "region": "INCONNUE", "vigilance": "VERTE", "type_phenomene": ""}
    rows = with_null_columns(rows, {c: "string" for c in (*text, *WEATHER_NUMBERS)})
    return rows.select(
        F.lit(run_date).cast("date").alias("date_mesure"),
        F.coalesce("departement", F.lit(text["departement"])).alias("departement"),
        F.coalesce("region", F.lit(text["region"])).alias("region"),
        *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in WEATHER_NUMBERS],
        F.coalesce("vigilance", F.lit(text["vigilance"])).alias("vigilance_meteo"),
        F.coalesce("type_phenomene", F.lit(text["type_phenomene"])).alias("type_phenomene"),
    )
