"""Estimates of merged sketches against the raw rows; grouping of the merges."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridvoice.operators import sketches as S


def rows(spark, n=60_000, clients=20_000):
    rng = random.Random(2)
    start = datetime(2024, 1, 1)
    data = []
    for k in range(n):
        at = start + timedelta(minutes=rng.randrange(0, 60 * 1440))
        data.append((at, rng.choice("NS"), "A", rng.randrange(clients), None if k % 7 == 0 else rng.lognormvariate(3, 1)))
    data += [(start, "N", "SANS", c, None) for c in range(5)]
    return spark.createDataFrame(data, "date_creation timestamp, region string, type_reclamation string, client_id long, duree_traitement_heures double")


def test_weeks_and_months_from_days(spark, tmp_path):
    raw = rows(spark)
    S.daily(raw).write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    for found, unit, name in ((S.weekly(daily), "week", "debut_semaine"), (S.monthly(daily), "month", "debut_mois")):
        seen = S.against_rows(S.estimates(found), raw, F.trunc("date_creation", unit), name).collect()
        assert len(seen) > 4 and all(r["clients_juste"] and r["mediane_juste"] for r in seen)
        assert sum(r["nombre_reclamations_total"] for r in seen) == raw.count()
    # an average of daily figures is far off
    month = S.estimates(S.monthly(daily)).filter("type_reclamation = 'A'").agg(F.avg("nb_clients")).first()[0]
    day = S.estimates(daily).filter("type_reclamation = 'A'").agg(F.avg("nb_clients")).first()[0]
    assert month > 10 * day


def test_merge_order_has_no_effect(spark):
    raw = rows(spark, 20_000)
    daily = S.daily(raw)
    direct = S.estimates(S.merged(daily, F.lit(1), "tout"))
    parts = S.merged(daily, F.dayofmonth("date_calcul") % 5, "cinquieme")
    staged = S.estimates(S.merged(parts, F.lit(1), "tout"))
    backwards = S.estimates(S.merged(daily.orderBy(F.desc("date_calcul")), F.lit(1), "tout"))

    def clients(df):
        return {(r["region"], r["type_reclamation"]): (r["nb_clients"], r["nombre_reclamations_total"]) for r in df.collect()}

    assert clients(direct) == clients(staged) == clients(backwards)
    for found in (direct, staged, backwards):
        assert all(r["mediane_juste"] for r in S.against_rows(found, raw, F.lit(1), "tout").collect())


def test_no_durations_no_median(spark):
    none = S.estimates(S.daily(rows(spark, 10))).filter("type_reclamation = 'SANS'").first()
    assert (none["nb_clients"], none["nb_durees"], none["duree_mediane"]) == (5, 0, None)
