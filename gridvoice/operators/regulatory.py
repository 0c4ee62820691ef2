"""Supply-continuity indices, legal delays and regulatory compliance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions import domains as D
from gridvoice.operators.consolidate import override

PLACE = ["region", "departement"]


def interruptions_per_client(rows: DataFrame, as_of: str, run_date: str, days: int = 365) -> DataFrame:
    """One row per place and client of consolidated complaints: outages of the run date, their hours, and whether the client is in
    the customer base (a complaint of any type in the last ``days`` days). Complaint ids are unique.

    It is all that the continuity indices need, merged before the shuffle, and small enough to be read twice.
    """
    outage = (F.col("type_reclamation") == "COUPURE_ELECTRIQUE") & (F.col("export_date") == F.lit(run_date).cast("date"))
    since = C.moment(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return rows.groupBy(*PLACE, "client_id").agg(
        F.count_if(outage).alias("outages"),
        F.sum(F.when(outage, F.coalesce("duree_heures", F.lit(0.0)))).alias("hours"),
        F.coalesce(F.max(F.col("date_creation") >= since), F.lit(False)).alias("in_base"),
    )


def continuity(clients: DataFrame, run_date: str) -> DataFrame:
    """Interruption minutes (SAIDI), frequency (SAIFI) and duration (CAIDI) per region and département.

    ``clients`` are the rows of ``interruptions_per_client``. The customer base is the region's distinct clients in the base.
    """
    base = (
        clients.filter("in_base AND client_id IS NOT NULL")
        .groupBy("region")
        .agg(F.count_distinct("client_id").alias("_base"))
    )
    outages = (
        clients.filter("outages > 0")
        .groupBy(*PLACE)
        .agg(
            F.sum("outages").alias("nb_interruptions"),
            F.sum("hours").alias("duree_totale_interruption_h"),
            F.count("client_id").alias("nb_clients_affectes"),
        )
    )
    minutes = F.col("duree_totale_interruption_h") * 60.0
    has_base = F.col("_base") > 0
    return outages.join(base, "region", "left").select(
        F.lit(run_date).cast("date").alias("date_calcul"),
        *PLACE,
        C.rounded(F.when(has_base, minutes * F.col("nb_clients_affectes") / F.col("_base")).otherwise(0.0), 4).alias(
            "saidi_minutes"
        ),
        C.rounded(F.when(has_base, F.col("nb_clients_affectes") / F.col("_base")).otherwise(0.0), 6).alias("saifi_index"),
        C.rounded(F.when(F.col("nb_clients_affectes") > 0, minutes).otherwise(0.0), 4).alias("caidi_minutes"),
        "nb_clients_affectes",
        "nb_interruptions",
        "duree_totale_interruption_h",
    )


def _on_time(total: Column, late: Column) -> Column:
    return C.rounded(F.when(total > 0, 100.0 * (total - late) / total).otherwise(100.0), 2)


def connection_delays(detail: DataFrame) -> DataFrame:
    """Connections over the 30-day legal delay, per region and département."""
    total, late = F.count(F.lit(1)), F.count_if(F.col("duree_heures") > D.CONNECTION_DELAY_DAYS * 24)
    return detail.groupBy(*PLACE).agg(
        total.alias("nb_raccordements_periode"),
        late.alias("nb_raccordements_hors_delai"),
        _on_time(total, late).alias("taux_respect_delai_raccordement"),
        C.rounded(F.avg(F.col("duree_heures") / 24.0), 2).alias("delai_moyen_raccordement_j"),
    )


def commissioning_delays(complaints: DataFrame, since: str, until: str) -> DataFrame:
    """Closed connections created in the period over the seven-day commissioning delay."""
    created = F.to_date("date_creation")
    total, late = F.count(F.lit(1)), F.count_if(F.col("duree_heures") > D.COMMISSIONING_DELAY_DAYS * 24)
    return (
        complaints.filter(
            created.between(F.lit(since).cast("date"), F.lit(until).cast("date"))
            & (F.col("type_reclamation") == "RACCORDEMENT_RESEAU")
            & (F.col("statut") == "CLOTURE")
        )
        .groupBy(*PLACE)
        .agg(
            total.alias("nb_mises_en_service"),
            late.alias("nb_mises_en_service_hors_delai"),
            _on_time(total, late).alias("taux_respect_delai_mes"),
        )
    )


def founded_complaints(consolidated: DataFrame) -> DataFrame:
    """Closed complaints resolved within their deadline count as founded."""
    total, founded = F.count(F.lit(1)), F.count_if("sla_respect")
    return (
        consolidated.filter(F.col("statut") == "CLOTURE")
        .groupBy("region", F.coalesce("departement", F.lit("INCONNU")).alias("departement"))
        .agg(
            founded.alias("nb_reclamations_fondees"),
            C.rounded(F.when(total > 0, 100.0 * founded / total).otherwise(0.0), 2).alias("taux_reclamations_fondees"),
        )
    )


def with_legal_columns(kpis: DataFrame, *details: DataFrame) -> DataFrame:
    """Fill the columns of each detail on matching places; other places keep nulls."""
    for detail in details:
        columns = [f for f in detail.schema.fields if f.name not in PLACE]
        empty = {f.name: F.lit(None).cast(f.dataType) for f in columns if f.name not in kpis.columns}
        kpis = override(kpis.withColumns(empty), detail, PLACE, [f.name for f in columns])
    return kpis


def alerts(kpis: DataFrame) -> DataFrame:
    """One row per exceeded limit."""
    yearly = F.coalesce("saidi_minutes", F.lit(0.0)) * 365
    limit = float(D.SAIDI_MAX_MINUTES_PER_YEAR)
    rate = F.col("taux_respect_delai_raccordement")
    saidi = kpis.filter(yearly > limit).select(
        *PLACE,
        F.lit("SAIDI_DEPASSE").alias("type_alerte"),
        yearly.alias("valeur_mesuree"),
        F.lit(limit).alias("seuil_legal"),
        C.rounded(100 * (yearly - limit) / limit, 4).alias("depassement_pct"),
    )
    # A zero rate counts as unmeasured, as a null one does.
    low = kpis.filter((rate != 0) & (rate < D.CONNECTION_RATE_MIN)).select(
        *PLACE,
        F.lit("DELAI_RACCORDEMENT_DEPASSE").alias("type_alerte"),
        rate.alias("valeur_mesuree"),
        F.lit(D.CONNECTION_RATE_MIN).alias("seuil_legal"),
        C.rounded(100 * (D.CONNECTION_RATE_MIN - rate) / D.CONNECTION_RATE_MIN, 4).alias("depassement_pct"),
    )
    return saidi.unionByName(low)


def with_compliance(kpis: DataFrame) -> DataFrame:
    """Compliance flag and the reasons against it, joined by ``; ``."""
    yearly = F.coalesce("saidi_minutes", F.lit(0.0)) * 365
    rate = F.col("taux_respect_delai_raccordement")
    reasons = [
        F.when(
            yearly > D.SAIDI_MAX_MINUTES_PER_YEAR,
            F.format_string(f"SAIDI annualisé=%.4fmin > seuil={D.SAIDI_MAX_MINUTES_PER_YEAR}min", yearly),
        ),
        F.when((rate != 0) & (rate < D.CONNECTION_RATE_MIN), F.format_string("Taux raccordement=%.2f%% < 90%%", rate)),
    ]
    joined = F.concat_ws("; ", *reasons)
    return kpis.withColumns(
        {"conforme_cre": joined == "", "motif_non_conformite": F.nullif(joined, F.lit(""))}
    )


def region_report(kpis: DataFrame) -> DataFrame:
    return (
        kpis.groupBy("region")
        .agg(
            C.exact_avg("saidi_minutes", 3).alias("saidi_moy"),
            C.exact_avg("saifi_index", 6).alias("saifi_moy"),
            C.exact_avg("taux_respect_delai_raccordement", 1).alias("taux_racc"),
            C.exact_avg("taux_respect_delai_mes", 1).alias("taux_mes"),
            F.count_if(~F.col("conforme_cre")).alias("non_conforme"),
        )
        .orderBy(F.desc("non_conforme"), "region")
    )
