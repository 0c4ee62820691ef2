"""Writers: layered Parquet, dated snapshots, slices, CSV and JDBC exports, audit log, manifest."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridvoice.operators import merge, privacy
from gridvoice.sources import readers, schemas


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Group rows by the output partitions, letting adaptive execution split the large ones.

    A plain repartition would write a hot region from one task.
    """
    return df.hint("rebalance", *columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = balanced(df, partition_by).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions present in ``df``; running again changes nothing."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, date_column: str = "date_calcul") -> None:
    """Dated snapshot: a rerun of the same date replaces it instead of adding duplicates."""
    replace_partitions(df, path, [date_column])


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], update: Sequence[str], partition: str
) -> None:
    """Merge ``source`` into a partitioned table, reading and rewriting only the partitions it touches.

    ``partition`` must be one of the keys, otherwise a key could sit elsewhere.
    """
    if partition not in keys:
        raise ValueError("the partition column must belong to the keys")
    touched = source.select(partition).distinct()
    current = spark.read.parquet(path).join(touched, partition, "left_semi")
    replace_partitions(merge.upsert(current, source, keys, update), path, [partition])


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Headered CSV, one part per task."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append", connections: int = 8
) -> None:
    """Database write; ``truncate`` keeps the table definition on overwrite."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=10_000, numPartitions=connections, truncate=True, **properties)
        .mode(mode)
        .save()
    )


def reload(df: DataFrame, path: str) -> None:
    """Full replacement of a table."""
    write_parquet(df, path)


def archive(df: DataFrame, directory: str, run_date: str) -> str | None:
    """Dated archive; nothing is written for an empty frame."""
    if df.isEmpty():
        return None
    path = f"{directory}/{run_date}"
    write_parquet(df, path)
    return path


def archive_table(
    spark: SparkSession, path: str, kept_path: str, directory: str, date_column: str, as_of: str, months: int = 12
) -> dict[str, int]:
    """Move old rows to an archive and the others to ``kept_path``; both are re-read and must add up."""
    table = spark.read.parquet(path)
    old, kept = privacy.split_archive(table, date_column, as_of, months)
    archived = archive(old, directory, as_of[:10])
    write_parquet(kept, kept_path)
    counts = {
        "total": table.count(),
        "archived": spark.read.parquet(archived).count() if archived else 0,
        "kept": spark.read.parquet(kept_path).count(),
    }
    if counts["archived"] + counts["kept"] != counts["total"]:
        raise RuntimeError(f"archive of {path} does not add up: {counts}")
    return counts


def log_run(
    spark: SparkSession, path: str, job: str, status: str, rows: int, seconds: float, at: str, message: str = ""
) -> None:
    """Append one line to the run log."""
    line = spark.createDataFrame(
        [(job, at[:10], status, int(rows), round(float(seconds), 2), message, at)],
        "dag_id string, run_date string, status string, rows_processed bigint, duration_seconds double, message string, created_at string",
    )
    line.withColumns(
        {"run_date": F.col("run_date").cast("date"), "created_at": F.col("created_at").cast("timestamp")}
    ).write.mode("append").parquet(path)


def quality_metrics(scores: DataFrame, table: str, check_date: str, good: float = 90.0) -> DataFrame:
    """Scores of one row in long form: table, date, metric, value, status."""
    names = [f.name for f in scores.schema.fields if f.dataType.typeName() == "double"]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("metric_value")) for n in names])
    return scores.select(F.explode(pairs).alias("p")).select(
        F.lit(table).alias("table_name"),
        F.lit(check_date).cast("date").alias("check_date"),
        "p.metric_name",
        "p.metric_value",
        F.when(F.col("p.metric_value") >= good, "OK").otherwise("ALERT").alias("status"),
    )


def serving_kpis(kpis: DataFrame) -> DataFrame:
    """Projection of the daily KPIs for the serving table: names, casts, defaults and order."""
    renamed = kpis.withColumnsRenamed(
        {
            "nombre_ouvertes": "nombre_reclamations_ouvertes",
            "nombre_cloturees": "nombre_reclamations_cloturees",
            "duree_moyenne_traitement": "duree_moyenne_traitement_heures",
            "duree_mediane_traitement": "duree_mediane_traitement_heures",
            "delai_moyen_premiere_reponse": "delai_moyen_premiere_reponse_heures",
        }
    )
    rates = ["taux_respect_sla", "taux_reclamations_critiques", "taux_escalade"]
    filled = {c: (F.col(c) if c in kpis.columns else F.lit(0)).cast("decimal(5,2)") for c in rates}
    return renamed.withColumns(filled).select(
        "date_calcul",
        "region",
        "type_reclamation",
        "nombre_reclamations_total",
        "nombre_reclamations_ouvertes",
        "nombre_reclamations_cloturees",
        "duree_moyenne_traitement_heures",
        "duree_mediane_traitement_heures",
        "delai_moyen_premiere_reponse_heures",
        *rates,
    )


# ---- reporting extracts -----------------------------------------------------------


def reporting_extracts(kpis: DataFrame, consolidated: DataFrame, weeks: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The four fixed extracts: daily KPIs (90 days), complaints (30 days), weeks, region overview (a year)."""
    from gridvoice.operators import kpi

    day = F.lit(as_of).cast("date")

    def recent(column: str, days: int) -> Column:
        return F.col(column) >= F.date_sub(day, days)

    return {
        "kpis_daily": kpis.filter(recent("date_calcul", 90)).select(
            "date_calcul",
            "region",
            "type_reclamation",
            "nombre_ouvertes",
            "nombre_cloturees",
            "duree_moyenne_traitement",
            "duree_mediane_traitement",
            "taux_respect_sla",
            "nb_critiques",
            "taux_escalade",
        ),
        "reclamations_global": consolidated.filter(recent("export_date", 30)),
        "kpis_hebdomadaires": weeks.select(
            "annee",
            "semaine",
            "debut_semaine",
            "fin_semaine",
            "region",
            "type_reclamation",
            "total_reclamations",
            "total_ouvertes",
            "total_cloturees",
            "duree_moyenne_heures",
            "taux_respect_sla",
            "evolution_vs_semaine_precedente",
        ),
        "sla_par_region": kpi.sla_by_region(kpis, as_of, 365),
    }


def write_extracts(extracts: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """One CSV folder per extract, values as Spark prints them, so that what is read back has the checksum of the frame."""
    paths = {}
    for name, df in extracts.items():
        paths[name] = f"{directory}/{name}"
        write_csv(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]), paths[name], sep=";")
    return paths


def fingerprint(df: DataFrame) -> Column:
    """Checksum of the rows that does not depend on their order: the sum of their hashes, as decimal digits.

    Copies add up instead of cancelling. A missing value has a mark of its own; an empty text counts as missing, as in a CSV file.
    """
    marked = [F.coalesce(F.concat(F.lit("="), F.nullif(F.col(f"`{c}`").cast("string"), F.lit(""))), F.lit("-")) for c in df.columns]
    return F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).cast("string")


def manifest(spark: SparkSession, paths: Mapping[str, str], sep: str = ";") -> DataFrame:
    """Rows, columns, bytes and checksum of each written extract, read back from storage."""
    parts = []
    for name, path in paths.items():
        df = spark.read.option("header", True).option("sep", sep).csv(path)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows"), fingerprint(df).alias("checksum")).select(
                F.lit(name).alias("extract"), "rows", F.lit(len(df.columns)).alias("columns"), "checksum"
            )
        )
        parts.append(
            files.select("length")
            .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
            .select(F.lit(name).alias("extract"), "bytes", "files")
        )
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy("extract").agg(*[F.max(c).alias(c) for c in ("rows", "columns", "bytes", "files", "checksum")])


def validate_outputs(spark: SparkSession, paths: Mapping[str, str], min_rows: Mapping[str, int] | int = 1) -> DataFrame:
    """Existence and row count of each written table against its minimum."""
    parts = None
    for name, path in paths.items():
        wanted = min_rows if isinstance(min_rows, int) else min_rows.get(name, 1)
        df = readers.optional_parquet(spark, path)
        counted = spark.range(1).select(F.lit(0).cast("long").alias("nb")) if df is None else df.agg(F.count(F.lit(1)).alias("nb"))
        row = counted.select(
            F.lit(name).alias("nom_table"),
            F.lit(df is not None).alias("existe"),
            "nb",
            ((F.col("nb") >= wanted) & F.lit(df is not None)).alias("valide"),
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts


# ---- multi-table ingest --------------------------------------------------------------


@dataclass(frozen=True)
class Ingested:
    table: str
    rows: int
    seconds: float
    error: str | None = None


def ingest(
    spark: SparkSession,
    tables: Mapping[str, str],
    target: Callable[[str], str],
    sep: str = ",",
    schema_of: Callable[[str], object] = schemas.schema,
) -> list[Ingested]:
    """Load each CSV into raw Parquet. A failing table is reported and does not stop the others.

    Rows are counted while they are written (an observation), not by another scan.
    """
    from pyspark.sql import Observation

    results = []
    for table, path in tables.items():
        began = time.monotonic()
        try:
            seen = Observation(f"rows_{table}")
            df = readers.read_csv(spark, path, schema_of(table), sep)
            df = readers.with_lineage(df).observe(seen, F.count(F.lit(1)).alias("n"))
            write_parquet(df, target(table))
            results.append(Ingested(table, seen.get["n"], time.monotonic() - began))
        except PySparkException as exc:
            results.append(Ingested(table, 0, time.monotonic() - began, str(exc)))
        except Exception as exc:  # errors raised by the JVM while writing
            results.append(Ingested(table, 0, time.monotonic() - began, f"{type(exc).__name__}: {exc}"))
    return results
