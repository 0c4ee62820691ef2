"""Quality scores, cleaning rules and deduplication."""

from pyspark.sql import functions as F

from gridvoice.functions import domains as D
from gridvoice.functions.skew import first_per_key
from gridvoice.operators import cleaning, quality
from gridvoice.plans.registry import query
from gridvoice.sources.conform import register_sql_view

_SHARE = "round(((1 - ({0})::DOUBLE / ({1})) * 100)::DECIMAL(28,8), 2)::DOUBLE"
_NULLS7 = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in D.REQUIRED_COLUMNS)
_BAD_TYPE = "count(*) FILTER (WHERE type_reclamation IS NULL OR type_reclamation NOT IN ('COUPURE_ELECTRIQUE', 'COMPTEUR_LINKY', 'FACTURATION', 'RACCORDEMENT_RESEAU', 'INTERVENTION_TECHNIQUE'))"
_BAD_STATUS = "count(*) FILTER (WHERE statut IS NULL OR statut NOT IN ('OUVERT', 'EN_COURS', 'CLOTURE', 'ESCALADE'))"
_BAD_PRIORITY = "count(*) FILTER (WHERE priorite IS NULL OR priorite NOT IN ('CRITIQUE', 'HAUTE', 'NORMALE', 'BASSE'))"
_BAD_DATES = "count(*) FILTER (WHERE date_cloture < date_creation)"
_AGREE = "abs(montant_ht::DECIMAL(24,6) + montant_tva::DECIMAL(24,6) - montant_ttc::DECIMAL(24,6)) <= 0.01"

# Complaints as they arrive: some ids twice, some keys missing.
register_sql_view(
    "raw_tickets",
    """SELECT CASE WHEN id_reclamation % 53 = 0 THEN id_reclamation + 1 ELSE id_reclamation END AS id_reclamation,
        CASE WHEN id_reclamation % 41 = 0 THEN NULL ELSE client_id END AS client_id, type_reclamation, priorite, statut,
        canal, region, date_creation, date_premiere_reponse, date_cloture, reference_linky FROM tickets""",
)


def raw_tickets(t):
    k = F.col("id_reclamation")
    return t.tickets.select(
        F.when(k % 53 == 0, k + 1).otherwise(k).alias("id_reclamation"),
        F.when(k % 41 != 0, F.col("client_id")).alias("client_id"),
        "type_reclamation",
        "priorite",
        "statut",
        "canal",
        "region",
        "date_creation",
        "date_premiere_reponse",
        "date_cloture",
        "reference_linky",
    )


@query(
    "q01_completeness",
    f"SELECT count(*) AS total, {_NULLS7} AS total_nulls, {_SHARE.format(_NULLS7, 'count(*) * 7')} AS score FROM raw_tickets",
)
def completeness(t):
    return quality.completeness(raw_tickets(t), D.REQUIRED_COLUMNS)


_ALL = ["id_reclamation", "client_id", "type_reclamation", "priorite", "statut", "canal", "region", "date_creation",
        "date_premiere_reponse", "date_cloture", "reference_linky"]
_NULLS_ALL = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _ALL)


@query(
    "q01_completeness_all_columns",
    f"SELECT count(*) AS total, {_NULLS_ALL} AS total_nulls, {_SHARE.format(_NULLS_ALL, 'count(*) * 11')} AS score FROM raw_tickets",
)
def completeness_all(t):
    return quality.completeness(raw_tickets(t))


@query(
    "q02_uniqueness",
    f"""SELECT count(*) AS total, count(*) - count(DISTINCT numero_facture) AS duplicates,
      {_SHARE.format('count(*) - count(DISTINCT numero_facture)', 'count(*)')} AS score FROM invoices""",
)
def uniqueness(t):
    return quality.uniqueness(t.invoices, "numero_facture")


@query(
    "q03_validity",
    f"""SELECT {_BAD_TYPE} AS types_invalides, {_BAD_STATUS} AS statuts_invalides, {_BAD_PRIORITY} AS priorites_invalides,
      {_SHARE.format(f'{_BAD_TYPE} + {_BAD_STATUS} + {_BAD_PRIORITY}', 'count(*) * 3')} AS score FROM tickets""",
)
def validity(t):
    return quality.validity(t.complaints)


@query(
    "q04_consistency",
    f"SELECT {_BAD_DATES} AS incoherentes, {_SHARE.format(_BAD_DATES, 'count(*)')} AS score FROM tickets",
)
def consistency(t):
    return quality.consistency(t.complaints)


_OVERALL = f"""SELECT count(*) AS total, {_SHARE.format(_NULLS7, 'count(*) * 7')} AS completude,
      {_SHARE.format(f'{_BAD_TYPE} + {_BAD_STATUS} + {_BAD_PRIORITY}', 'count(*) * 3')} AS validite,
      {_SHARE.format(_BAD_DATES, 'count(*)')} AS coherence,
      count(*) - count(DISTINCT id_reclamation) AS duplicates,
      {_SHARE.format('count(*) - count(DISTINCT id_reclamation)', 'count(*)')} AS unicite FROM raw_tickets"""


@query(
    "q05_weighted_score",
    f"""SELECT *, round((completude * 0.3::DOUBLE + unicite * 0.3::DOUBLE + validite * 0.2::DOUBLE + coherence * 0.2::DOUBLE)::DECIMAL(28,8), 2)::DOUBLE AS score_global,
      round((completude * 0.3::DOUBLE + unicite * 0.3::DOUBLE + validite * 0.2::DOUBLE + coherence * 0.2::DOUBLE)::DECIMAL(28,8), 2)::DOUBLE >= 90 AS accepte FROM ({_OVERALL})""",
)
def weighted_score(t):
    return quality.overall(raw_tickets(t))


@query(
    "q06_null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS colonne, count(*) FILTER (WHERE {c} IS NULL) AS nb_nulls, "
        f"round((count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*))::DECIMAL(28,8), 2)::DOUBLE AS pct_nulls FROM raw_tickets"
        for c in _ALL
    ),
)
def null_profile(t):
    return quality.null_profile(raw_tickets(t))


@query(
    "q07_layer_gate",
    f"""WITH o AS ({_OVERALL})
    SELECT mesure, score, seuil, score >= seuil AS accepte FROM (
      SELECT 'completeness' AS mesure, completude AS score, 90.0::DOUBLE AS seuil FROM o
      UNION ALL SELECT 'validity', validite, 95.0 FROM o UNION ALL SELECT 'consistency', coherence, 90.0 FROM o
      UNION ALL SELECT 'uniqueness', unicite, 98.0 FROM o)""",
)
def layer_gate(t):
    return quality.layer_gate(raw_tickets(t), "silver")


@query(
    "q08_meter_validity",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE NOT regexp_full_match(reference_linky, 'LKY[0-9]{{8}}')) AS references_invalides,
      count(*) FILTER (WHERE puissance_souscrite_kva NOT IN (3, 6, 9, 12, 15, 18, 24, 36)) AS puissances_invalides,
      {_SHARE.format("count(*) FILTER (WHERE NOT regexp_full_match(reference_linky, 'LKY[0-9]{8}')) + count(*) FILTER (WHERE puissance_souscrite_kva NOT IN (3, 6, 9, 12, 15, 18, 24, 36))", 'count(*)')} AS score
    FROM meters""",
)
def meter_validity(t):
    return quality.meter_validity(t.meters)


@query(
    "q09_invoice_consistency",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE NOT ({_AGREE})) AS montants_incoherents,
      count(*) FILTER (WHERE date_echeance < date_emission) AS dates_incoherentes,
      {_SHARE.format(f'count(*) FILTER (WHERE NOT ({_AGREE})) + count(*) FILTER (WHERE date_echeance < date_emission)', 'count(*)')} AS score
    FROM invoices""",
)
def invoice_consistency(t):
    return quality.invoice_consistency(t.invoices)


_TICKET_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ["date_creation", "client_id", "type_reclamation", "priorite", "statut", "canal", "region",
              "date_premiere_reponse", "date_cloture", "reference_linky"]
)


@query(
    "q10_clean_complaints",
    f"""WITH u AS (SELECT * FROM raw_tickets WHERE client_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id_reclamation ORDER BY {_TICKET_ORDER}) = 1)
    SELECT id_reclamation, client_id, type_reclamation, priorite, statut, trim(canal) AS canal, region,
      date_creation::VARCHAR AS date_creation, date_premiere_reponse::VARCHAR AS date_premiere_reponse, date_cloture::VARCHAR AS date_cloture,
      CASE WHEN regexp_full_match(reference_linky, 'LKY[0-9]{{8}}') THEN reference_linky END AS reference_linky
    FROM u WHERE coalesce(date_premiere_reponse >= date_creation, TRUE) AND coalesce(date_cloture >= date_creation, TRUE)""",
)
def clean_complaints(t):
    return cleaning.clean_complaints(raw_tickets(t))


@query(
    "q10_clean_meters",
    """SELECT reference_linky, client_id, type_compteur, puissance_souscrite_kva, region, departement,
      date_installation::VARCHAR AS date_installation, est_defectueux, nombre_incidents
    FROM meters WHERE regexp_full_match(reference_linky, 'LKY[0-9]{8}')
      AND puissance_souscrite_kva IN (3, 6, 9, 12, 15, 18, 24, 36)""",
)
def clean_meters(t):
    return cleaning.clean_meters(t.meters)


_INVOICE_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ["reference_linky", "date_emission", "date_echeance", "montant_ht", "montant_tva", "montant_ttc",
              "est_contestee", "motif_contestation"]
)


@query(
    "q10_clean_invoices",
    f"""SELECT numero_facture, reference_linky, date_emission::VARCHAR AS date_emission, date_echeance::VARCHAR AS date_echeance,
      round(montant_ht, 4) AS montant_ht, round(montant_tva, 4) AS montant_tva, round(montant_ttc, 4) AS montant_ttc,
      est_contestee, motif_contestation
    FROM (SELECT * FROM invoices WHERE {_AGREE} AND date_echeance >= date_emission)
    QUALIFY row_number() OVER (PARTITION BY numero_facture ORDER BY {_INVOICE_ORDER}) = 1""",
)
def clean_invoices(t):
    return cleaning.clean_invoices(t.invoices)


@query(
    "q11_expectations",
    """SELECT regle, nb_violations, nb_violations = 0 AS respectee FROM (
      SELECT 'client_id: non nul' AS regle, count(*) FILTER (WHERE client_id IS NULL) AS nb_violations FROM raw_tickets
      UNION ALL SELECT 'priorite: domaine', count(*) FILTER (WHERE priorite NOT IN ('CRITIQUE', 'HAUTE', 'NORMALE', 'BASSE')) FROM raw_tickets
      UNION ALL SELECT 'reference_linky: format', count(*) FILTER (WHERE NOT regexp_full_match(reference_linky, 'LKY[0-9]{8}')) FROM raw_tickets
      UNION ALL SELECT 'client_id: intervalle', count(*) FILTER (WHERE client_id NOT BETWEEN 10 AND 1000000000) FROM raw_tickets
      UNION ALL SELECT 'date_cloture >= date_creation', count(*) FILTER (WHERE date_cloture < date_creation) FROM raw_tickets
      UNION ALL SELECT 'id_reclamation: unicite', count(*) - count(DISTINCT id_reclamation) FROM raw_tickets)""",
)
def expectations(t):
    return quality.expectations(
        raw_tickets(t),
        [
            quality.not_null("client_id"),
            quality.in_set("priorite", D.PRIORITIES),
            quality.matches("reference_linky", D.METER_REFERENCE),
            quality.between("client_id", 10, 1000000000),
            quality.ordered("date_creation", "date_cloture"),
        ],
        unique=["id_reclamation"],
    )


@query(
    "p13_mandatory_fields",
    "SELECT region, count(*) AS nb FROM raw_tickets WHERE client_id IS NOT NULL GROUP BY 1",
)
def mandatory_fields(t):
    return cleaning.require(raw_tickets(t)).groupBy("region").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "p14_date_order",
    """SELECT count(*) FILTER (WHERE coalesce(date_premiere_reponse >= date_creation, TRUE) AND coalesce(date_cloture >= date_creation, TRUE)) AS conserves,
      count(*) FILTER (WHERE NOT (coalesce(date_premiere_reponse >= date_creation, TRUE) AND coalesce(date_cloture >= date_creation, TRUE))) AS rejetes
    FROM tickets""",
)
def date_order(t):
    ok = cleaning.in_order("date_creation", "date_premiere_reponse") & cleaning.in_order("date_creation", "date_cloture")
    return t.complaints.agg(F.count_if(ok).alias("conserves"), F.count_if(~ok).alias("rejetes"))


@query(
    "p15_reference_format",
    """SELECT id_reclamation, reference_linky, regexp_full_match(reference_linky, 'LKY[0-9]{8}') AS reference_valide FROM tickets""",
)
def reference_format(t):
    return t.complaints.select(
        "id_reclamation", "reference_linky", cleaning.is_valid_reference().alias("reference_valide")
    )


@query(
    "p16_power_domain",
    """SELECT puissance_souscrite_kva, count(*) AS nb FROM meters
    WHERE puissance_souscrite_kva IN (3, 6, 9, 12, 15, 18, 24, 36) GROUP BY 1""",
)
def power_domain(t):
    return (
        t.meters.filter(cleaning.in_domain("puissance_souscrite_kva", D.METER_POWERS))
        .groupBy("puissance_souscrite_kva")
        .agg(F.count(F.lit(1)).alias("nb"))
    )


@query(
    "p17_amount_consistency",
    f"""SELECT numero_facture, round(montant_ht, 4) AS montant_ht, round(montant_ttc, 4) AS montant_ttc
    FROM invoices WHERE NOT ({_AGREE})""",
)
def amount_consistency(t):
    return t.invoices.filter(~cleaning.amounts_agree()).select("numero_facture", "montant_ht", "montant_ttc")


@query("p18_trimmed_text", "SELECT trim(canal) AS canal, count(*) AS nb FROM tickets GROUP BY 1")
def trimmed_text(t):
    return cleaning.trim(t.complaints).groupBy("canal").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "a50_dedup_by_key",
    f"""SELECT numero_facture, reference_linky, round(montant_ttc, 4) AS montant_ttc FROM invoices
    QUALIFY row_number() OVER (PARTITION BY numero_facture ORDER BY {_INVOICE_ORDER}) = 1""",
)
def dedup_by_key(t):
    return first_per_key(t.invoices, ["numero_facture"]).select("numero_facture", "reference_linky", "montant_ttc")


@query("a49_distinct", "SELECT DISTINCT region, type_reclamation FROM tickets")
def distinct_pairs(t):
    return t.tickets.select("region", "type_reclamation").distinct()


@query(
    "w04_keep_first_kept",
    """SELECT id_reclamation FROM tickets QUALIFY row_number() OVER (PARTITION BY client_id, CAST(date_creation AS DATE), type_reclamation
      ORDER BY date_creation, id_reclamation) = 1""",
)
def keep_first(t):
    kept, _ = cleaning.split_duplicates(
        t.complaints, cleaning.same_client_day_type(), "date_creation", "id_reclamation"
    )
    return kept.select("id_reclamation")


@query(
    "w04_keep_first_duplicates",
    """SELECT id_reclamation, client_id, type_reclamation FROM tickets QUALIFY row_number() OVER (
      PARTITION BY client_id, CAST(date_creation AS DATE), type_reclamation ORDER BY date_creation, id_reclamation) > 1""",
)
def set_aside(t):
    _, duplicates = cleaning.split_duplicates(
        t.complaints, cleaning.same_client_day_type(), "date_creation", "id_reclamation"
    )
    return duplicates.select("id_reclamation", "client_id", "type_reclamation")


register_sql_view(
    "quality_runs",
    """SELECT ts AS execution_date, 80 + value % 20 AS overall_quality_score FROM events""",
)


@query(
    "a52_recent_quality",
    """SELECT round(coalesce(avg(overall_quality_score), 100.0), 4) AS score_moyen FROM quality_runs
    WHERE execution_date >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS""",
)
def recent_quality(t):
    runs = t.raw("events").select(
        F.col("ts").cast("timestamp").alias("execution_date"), (80 + F.col("value") % 20).alias("overall_quality_score")
    )
    return quality.recent_average(runs, F.lit("2024-01-31 00:00:00").cast("timestamp"), hours=24)
