"""Readers, writers, merges and the layered batch on small tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridvoice import layers
from gridvoice.operators import merge, privacy, quality
from gridvoice.sources import readers, schemas, scratch, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tables(spark):
    target = spark.createDataFrame([(1, "a", 10, "x"), (2, "b", 20, "y")], "k int, p string, v int, w string")
    source = spark.createDataFrame([(2, "b", None), (3, "c", 30)], "k int, p string, v int")
    return target, source


def test_upsert_changes_only_listed_columns(tables):
    target, source = tables
    once = merge.upsert(target, source, ["k", "p"], ["v"])
    assert rows(once) == [(1, "a", 10, "x"), (2, "b", None, "y"), (3, "c", 30, None)]
    assert rows(merge.upsert(once, source, ["k", "p"], ["v"])) == rows(once)


def test_upsert_partitions_leaves_others_alone(spark, tables, tmp_path):
    target, source = tables
    path = str(tmp_path / "t")
    sinks.write_parquet(target, path, ["p"])
    untouched = sorted((tmp_path / "t" / "p=a").iterdir())
    for _ in range(2):
        sinks.upsert_partitions(spark, path, source, ["k", "p"], ["v"], "p")
    assert rows(spark.read.parquet(path).select("k", "p", "v", "w")) == [(1, "a", 10, "x"), (2, "b", None, "y"), (3, "c", 30, None)]
    assert sorted((tmp_path / "t" / "p=a").iterdir()) == untouched
    with pytest.raises(ValueError):
        sinks.upsert_partitions(spark, path, source, ["k"], ["v"], "p")


def test_insert_if_absent_and_slice(spark, tables):
    target, _ = tables
    source = spark.createDataFrame([(1, "z", 0, "n"), (5, "q", 2, "n"), (5, "q", 1, "n")], "k int, p string, v int, w string")
    merged = merge.insert_if_absent(target, source, ["k"])
    assert rows(merged) == [(1, "a", 10, "x"), (2, "b", 20, "y"), (5, "q", 1, "n")]
    sliced = merge.replace_slice(target, source, F.col("k") == 1)
    assert rows(merge.replace_slice(sliced, source, F.col("k").isin(1, 5))) == rows(sliced)


def test_contract_and_not_null(spark):
    expected = T.StructType.fromDDL("a INT NOT NULL, b STRING")
    df = spark.createDataFrame([(1, "x"), (None, "y")], "a int, c string")
    contract = readers.check_contract(df, expected, "t")
    assert not contract.ok and contract.errors == ["missing columns: ['b']"] and contract.warnings == ["extra columns: ['c']"]
    assert readers.check_contract(df.limit(0).select("a", F.lit("z").alias("b")), expected, "t").errors == ["no rows"]
    assert readers.enforce_not_null(df, expected).count() == 1


def test_declared_schemas(spark):
    assert len(schemas.DDL) == 9
    fields = {f.name: f for f in schemas.schema("reclamations").fields}
    assert fields["departement"].dataType == T.StringType() and not fields["id_reclamation"].nullable
    with pytest.raises(ValueError):
        schemas.layer_path("/x", "platinum", "t")


def test_weather_csv_defaults(spark, tmp_path):
    file = tmp_path / "w.csv"
    file.write_text("departement;region;vent_max_ms;vent_rafales_ms;precipitation_mm;neige_cm;temperature_min_c;temperature_max_c;vigilance;type_phenomene\n75;IDF;3.5;;abc;1;2;3;;\n")
    row = readers.read_weather_csv(spark, str(file), "2024-01-01").first()
    assert (row.vent_max_ms, row.vent_rafales_ms, row.precipitation_mm, row.vigilance_meteo, row.type_phenomene) == (3.5, 0.0, 0.0, "VERTE", "")


def test_optional_source(spark, tmp_path):
    assert readers.optional_parquet(spark, str(tmp_path / "none")) is None
    df = readers.with_null_columns(spark.range(1), {"x": "double"})
    assert df.schema["x"].dataType == T.DoubleType()


def test_ingest_isolates_failures(spark, tmp_path):
    (tmp_path / "clients.csv").write_text("client_id,nom,type_client,region,date_inscription,latitude,longitude\nC1,N,P,R,2024-01-01,1.0,2.0\n")
    done = sinks.ingest(
        spark,
        {"incidents": str(tmp_path / "absent.csv"), "clients": str(tmp_path / "clients.csv")},
        lambda t: schemas.layer_path(str(tmp_path), "bronze", t),
    )
    assert [(r.table, r.rows, r.error is None) for r in done] == [("incidents", 0, False), ("clients", 1, True)]
    written = spark.read.parquet(schemas.layer_path(str(tmp_path), "bronze", "clients"))
    assert {"ingestion_date", "source_file"} <= set(written.columns)


def test_manifest_and_validation(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    paths = sinks.write_extracts({"one": df, "same": df.orderBy(F.desc("k"))}, str(tmp_path))
    got = {r.extract: r for r in sinks.manifest(spark, paths).collect()}
    assert (got["one"].rows, got["one"].columns) == (2, 2) and got["one"].bytes > 0
    assert got["one"].checksum == got["same"].checksum
    sinks.write_parquet(df, str(tmp_path / "p"))
    checked = {r.nom_table: (r.existe, r.nb, r.valide) for r in sinks.validate_outputs(spark, {"p": str(tmp_path / "p"), "q": str(tmp_path / "q")}, 2).collect()}
    assert checked == {"p": (True, 2, True), "q": (False, 0, False)}


def test_checksum_counts_copies_and_missing_values(spark):
    def checksum(rows):
        return sinks_checksum(spark.createDataFrame(rows, "k int, t string"))

    def sinks_checksum(df):
        return df.agg(sinks.fingerprint(df)).first()[0]

    a, b = (1, "a"), (2, "b")
    assert len({checksum(r) for r in ([a, a], [b, b], [a], [a, b], [a, a, b, b])}) == 5
    assert checksum([(1, None)]) != checksum([(None, "1")])
    assert checksum([a, b]) == checksum([b, a])


def test_archive_check_finds_lost_rows(spark):
    table = spark.range(10)
    good = privacy.archive_check(table, table.filter("id < 4"), table.filter("id >= 4")).first()
    assert tuple(good) == (4, 4, 6, True)
    lost = privacy.archive_check(table, table.filter("id < 3"), table.filter("id >= 4")).first()
    assert tuple(lost) == (3, 4, 6, False)


def test_ingest_reports_the_whole_error(spark, tmp_path):
    done = sinks.ingest(spark, {"reclamations": str(tmp_path / "missing")}, lambda t: str(tmp_path / "out" / t))
    assert done[0].error and "missing" in done[0].error


def test_archive_skips_empty(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    assert sinks.archive(df.limit(0), str(tmp_path / "a"), "2024-01-01") is None
    assert spark.read.parquet(sinks.archive(df, str(tmp_path / "a"), "2024-01-01")).count() == 1


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for status in ("SUCCESS", "FAILED"):
        sinks.log_run(spark, path, "job", status, 3, 1.239, "2024-01-01 10:00:00", "m" * 5000 + "\nsecond line")
    got = spark.read.parquet(path).orderBy("status").collect()
    assert [(r.status, r.duration_seconds, len(r.message)) for r in got] == [("FAILED", 1.24, 5012), ("SUCCESS", 1.24, 5012)]


def test_layers_end_to_end_and_gate(spark, tmp_path):
    data = [
        ("1", "C1", "FACTURATION", "HAUTE", "OUVERT", "WEB", "A", "2024-01-01 10:00:00", None, None, "LKY00000001"),
        ("1", "C1", "FACTURATION", "HAUTE", "OUVERT", "WEB", "A", "2024-01-01 10:00:00", None, None, "LKY00000001"),
        ("2", "C1", "FACTURATION", "BASSE", "CLOTURE", "WEB", "A", "2024-01-01 10:00:00", None, "2024-01-03 10:00:00", None),
    ]
    names = "id_reclamation client_id type_reclamation priorite statut canal region date_creation date_premiere_reponse date_cloture reference_linky".split()
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in names if c.startswith("date_")})
    root = str(tmp_path)
    sinks.write_parquet(df, schemas.layer_path(root, "bronze", "reclamations"))
    layers.clean(spark, root)
    for _ in range(2):
        paths = layers.publish(spark, root, "2024-01-05 00:00:00", quality_threshold=90.0)
    kpis = spark.read.parquet(paths["kpis_daily"]).collect()
    assert [(r.nombre_reclamations_total, r.nb_recurrentes, str(r.date_calcul)) for r in kpis] == [(2, 2, "2024-01-05")]
    assert sinks.serving_kpis(spark.read.parquet(paths["kpis_daily"])).first().taux_escalade is not None
    with pytest.raises(quality.QualityError):
        layers.publish(spark, root, "2024-01-05 00:00:00", quality_threshold=100.1)


def test_scratch_uses_the_configured_folder(spark):
    configured = spark.conf.get(scratch.SETTING, None)
    root = scratch.shared_root(spark)
    assert root == (configured or spark.conf.get(scratch.SETTING))
    assert scratch.new_path(spark, "a") != scratch.new_path(spark, "a")


def test_scratch_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_MADE", [])
    kept = scratch.materialise(spark.range(3), "three")
    assert kept.count() == 3
    scratch.new_path(spark, "never written")
    assert scratch.drop_all(spark) == 1 and scratch.drop_all(spark) == 0


@pytest.mark.parametrize("size,partitions", [(0, 8), (100 * 1024**2, 8), (200 * 1024**4, 819_200), (10 * 1024**4, 40_960)])
def test_shuffle_partitions_follow_the_input(size, partitions):
    from gridvoice import session

    assert session.shuffle_partitions(size) == partitions
    assert session.settings(size)["spark.sql.adaptive.skewJoin.enabled"] == "true"
