"""Continuity indices, legal delays and weather impact."""

from pyspark.sql import functions as F

from gridvoice.operators import consolidate, enrich, regulatory, sla, weather
from gridvoice.plans.incidents import merged
from gridvoice.plans.periods import RUN, consolidated
from gridvoice.plans.registry import query
from gridvoice.sources.conform import AS_OF, register_sql_view

register_sql_view(
    "continuity",
    f"""SELECT region, departement, nb_interruptions, duree AS duree_totale_interruption_h, nb_clients_affectes,
        round(CASE WHEN base > 0 THEN duree * 60.0::DOUBLE * nb_clients_affectes / base ELSE 0 END, 4) AS saidi_minutes,
        round(CASE WHEN base > 0 THEN nb_clients_affectes::DOUBLE / base ELSE 0 END, 6) AS saifi_index,
        round(CASE WHEN nb_clients_affectes > 0 THEN duree * 60.0::DOUBLE ELSE 0 END, 4) AS caidi_minutes
      FROM (SELECT region, departement, count(DISTINCT id_reclamation) AS nb_interruptions, sum(coalesce(duree_heures, 0)) AS duree,
          count(DISTINCT client_id) AS nb_clients_affectes FROM consolidated
        WHERE type_reclamation = 'COUPURE_ELECTRIQUE' AND export_date = DATE '{RUN}' GROUP BY 1, 2)
      LEFT JOIN (SELECT region, count(DISTINCT client_id) AS base FROM tickets
        WHERE date_creation >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS GROUP BY 1) USING (region)""",
)
register_sql_view(
    "connections",
    """SELECT region, departement, count(*) AS nb_raccordements_periode, count(*) FILTER (WHERE duree_heures > 720) AS nb_raccordements_hors_delai,
        round((100.0::DOUBLE * (count(*) - count(*) FILTER (WHERE duree_heures > 720)) / count(*))::DECIMAL(28,8), 2)::DOUBLE AS taux_respect_delai_raccordement,
        round((avg(duree_heures / 24.0::DOUBLE))::DECIMAL(28,8), 2)::DOUBLE AS delai_moyen_raccordement_j
      FROM connection_base GROUP BY 1, 2""",
)
register_sql_view(
    "commissionings",
    """SELECT region, departement, count(*) AS nb_mises_en_service, count(*) FILTER (WHERE duree_heures > 168) AS nb_mises_en_service_hors_delai,
        round((100.0::DOUBLE * (count(*) - count(*) FILTER (WHERE duree_heures > 168)) / count(*))::DECIMAL(28,8), 2)::DOUBLE AS taux_respect_delai_mes
      FROM timed WHERE type_reclamation = 'RACCORDEMENT_RESEAU' AND statut = 'CLOTURE'
        AND CAST(date_creation AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2001-08-02' GROUP BY 1, 2""",
)
register_sql_view(
    "founded",
    """SELECT region, departement, count(*) FILTER (WHERE sla_respect) AS nb_reclamations_fondees,
        round((100.0::DOUBLE * count(*) FILTER (WHERE sla_respect) / count(*))::DECIMAL(28,8), 2)::DOUBLE AS taux_reclamations_fondees
      FROM consolidated WHERE statut = 'CLOTURE' GROUP BY 1, 2""",
)
register_sql_view(
    "legal",
    """SELECT c.*, nb_raccordements_periode, nb_raccordements_hors_delai, taux_respect_delai_raccordement, delai_moyen_raccordement_j,
        nb_mises_en_service, nb_mises_en_service_hors_delai, taux_respect_delai_mes, nb_reclamations_fondees, taux_reclamations_fondees
      FROM continuity c LEFT JOIN connections USING (region, departement) LEFT JOIN commissionings USING (region, departement)
        LEFT JOIN founded USING (region, departement)""",
)
register_sql_view(
    "judged",
    """SELECT *, concat_ws('; ',
        CASE WHEN saidi_minutes * 365 > 60 THEN printf('SAIDI annualisé=%.4fmin > seuil=60min', saidi_minutes * 365) END,
        CASE WHEN taux_respect_delai_raccordement <> 0 AND taux_respect_delai_raccordement < 90
          THEN printf('Taux raccordement=%.2f%% < 90%%', taux_respect_delai_raccordement) END) AS motifs FROM legal""",
)


def continuity(t):
    """From one scan of the complaints. The indices take none of the columns that specialised details override, so no detail is joined."""

    def clients():
        rows = consolidate.base(enrich.with_durations(t.tickets), RUN)
        return regulatory.interruptions_per_client(rows, AS_OF, RUN)

    return regulatory.continuity(t.kept("interruptions", clients), RUN)


def legal(t):
    timed = enrich.with_elapsed(t.tickets, AS_OF)
    return regulatory.with_legal_columns(
        continuity(t),
        regulatory.connection_delays(sla.detail(t.tickets, "RACCORDEMENT_RESEAU", AS_OF)),
        regulatory.commissioning_delays(timed, "2000-01-01", RUN),
        regulatory.founded_complaints(consolidated(t)),
    )


@query(
    "a24_continuity_indices",
    f"""SELECT '{RUN}' AS date_calcul, region, departement, saidi_minutes, round(saifi_index, 4) AS saifi_index, caidi_minutes, nb_clients_affectes,
      nb_interruptions, round(duree_totale_interruption_h, 4) AS duree_totale_interruption_h FROM continuity""",
)
def continuity_indices(t):
    return continuity(t)


@query("a25_connection_delays", "SELECT * FROM connections")
def connection_delays(t):
    return regulatory.connection_delays(sla.detail(t.tickets, "RACCORDEMENT_RESEAU", AS_OF))


@query("a25_commissioning_delays", "SELECT * FROM commissionings")
def commissioning_delays(t):
    return regulatory.commissioning_delays(enrich.with_elapsed(t.tickets, AS_OF), "2000-01-01", RUN)


@query("a26_founded_rate", "SELECT * FROM founded")
def founded_rate(t):
    return regulatory.founded_complaints(consolidated(t))


@query(
    "p35_compliance_flags",
    "SELECT region, departement, saidi_minutes, taux_respect_delai_raccordement, motifs = '' AS conforme_cre, nullif(motifs, '') AS motif_non_conformite FROM judged",
)
def compliance_flags(t):
    return regulatory.with_compliance(legal(t)).select(
        "region", "departement", "saidi_minutes", "taux_respect_delai_raccordement", "conforme_cre", "motif_non_conformite"
    )


@query(
    "p35_compliance_alerts",
    """SELECT region, departement, 'SAIDI_DEPASSE' AS type_alerte, round(saidi_minutes * 365, 4) AS valeur_mesuree, 60.0::DOUBLE AS seuil_legal,
      round(100 * (saidi_minutes * 365 - 60) / 60, 4) AS depassement_pct FROM legal WHERE saidi_minutes * 365 > 60
    UNION ALL SELECT region, departement, 'DELAI_RACCORDEMENT_DEPASSE', taux_respect_delai_raccordement, 90.0,
      round(100 * (90.0 - taux_respect_delai_raccordement) / 90.0::DOUBLE, 4) FROM legal
      WHERE taux_respect_delai_raccordement <> 0 AND taux_respect_delai_raccordement < 90""",
)
def compliance_alerts(t):
    return regulatory.alerts(legal(t))


@query(
    "a27_region_report",
    """SELECT region, round((avg(saidi_minutes))::DECIMAL(28,8), 3)::DOUBLE AS saidi_moy, round(round(avg(saifi_index), 6), 4) AS saifi_moy,
      round(((sum(taux_respect_delai_raccordement::DECIMAL(20,6))::DOUBLE / count(taux_respect_delai_raccordement)))::DECIMAL(28,8), 1)::DOUBLE AS taux_racc, round(((sum(taux_respect_delai_mes::DECIMAL(20,6))::DOUBLE / count(taux_respect_delai_mes)))::DECIMAL(28,8), 1)::DOUBLE AS taux_mes,
      count(*) FILTER (WHERE motifs <> '') AS non_conforme FROM judged GROUP BY 1""",
)
def region_report(t):
    return regulatory.region_report(regulatory.with_compliance(legal(t)))


register_sql_view(
    "classified",
    """SELECT date_mesure, region, departement,
        CASE WHEN NOT (vigilance_meteo = 'VERTE' OR type_phenomene = 'AUCUN') THEN vigilance_meteo
          WHEN vent_rafales_ms >= 28 OR precipitation_mm >= 50 OR neige_cm >= 20 THEN 'ROUGE'
          WHEN vent_rafales_ms >= 20 OR precipitation_mm >= 30 OR neige_cm >= 10 THEN 'ORANGE'
          WHEN vent_rafales_ms >= 15 OR precipitation_mm >= 15 THEN 'JAUNE' ELSE 'VERTE' END AS vigilance_meteo,
        CASE WHEN NOT (vigilance_meteo = 'VERTE' OR type_phenomene = 'AUCUN') THEN type_phenomene
          WHEN vent_rafales_ms >= 20 THEN 'VENT_VIOLENT' WHEN neige_cm >= 10 THEN 'NEIGE_VERGLAS'
          WHEN precipitation_mm >= 30 THEN 'PLUIE_INTENSE' WHEN temperature_max_c >= 35 THEN 'CANICULE'
          WHEN temperature_min_c <= -5 THEN 'GEL' ELSE 'NORMAL' END AS type_phenomene
      FROM weather""",
)
register_sql_view(
    "region_weather",
    """SELECT date_mesure, region, vigilance_meteo, min(type_phenomene) AS type_phenomene FROM classified GROUP BY 1, 2, 3
      QUALIFY row_number() OVER (PARTITION BY date_mesure, region ORDER BY CASE vigilance_meteo WHEN 'ROUGE' THEN 3
        WHEN 'ORANGE' THEN 2 WHEN 'JAUNE' THEN 1 ELSE 0 END DESC) = 1""",
)
IMPACT_DAY = "2024-01-25"
register_sql_view(
    "impacts",
    f"""SELECT region, nb AS nb_coupures_jour, round((base)::DECIMAL(28,8), 2)::DOUBLE AS nb_coupures_baseline, round((nb - coalesce(base, nb))::DECIMAL(28,8), 2)::DOUBLE AS surplus_coupures,
        round((CASE WHEN base > 0 THEN 100.0::DOUBLE * (nb - base) / base ELSE 0 END)::DECIMAL(28,8), 2)::DOUBLE AS impact_meteo_pct,
        coalesce(vigilance_meteo, 'VERTE') AS vigilance_jour, coalesce(type_phenomene, 'NORMAL') AS type_phenomene,
        CASE vigilance_meteo WHEN 'ROUGE' THEN 'CRISE_METEO' WHEN 'ORANGE' THEN 'TEMPETE' WHEN 'JAUNE' THEN 'METEO_MODEREE' ELSE 'NORMAL' END AS classification_jour,
        vigilance_meteo
      FROM (SELECT region, sum(nombre_ouvertes + nombre_cloturees)::BIGINT AS nb FROM daily_kpi
          WHERE date_calcul = DATE '{IMPACT_DAY}' AND type_reclamation = 'COUPURE_ELECTRIQUE' GROUP BY 1)
      LEFT JOIN (SELECT k.region, avg(nombre_ouvertes + nombre_cloturees) AS base FROM daily_kpi k
          LEFT JOIN region_weather w ON k.date_calcul = w.date_mesure AND k.region = w.region
          WHERE k.date_calcul BETWEEN DATE '{IMPACT_DAY}' - 30 AND DATE '{IMPACT_DAY}' - 1 AND type_reclamation = 'COUPURE_ELECTRIQUE'
            AND coalesce(vigilance_meteo, 'VERTE') NOT IN ('ORANGE', 'ROUGE') GROUP BY 1) USING (region)
      LEFT JOIN (SELECT region, vigilance_meteo, type_phenomene FROM region_weather WHERE date_mesure = DATE '{IMPACT_DAY}') USING (region)""",
)


def region_weather(t):
    """One row per region and day, stored because the baseline and the day's conditions both read it."""
    return t.kept("region_weather", lambda: weather.worst_per_region(weather.classify(t.weather)))


@query(
    "p22_vigilance_level",
    "SELECT date_mesure::VARCHAR AS date_mesure, departement, vigilance_meteo FROM classified",
)
def vigilance_level(t):
    return weather.classify(t.weather).select("date_mesure", "departement", "vigilance_meteo")


@query(
    "p23_phenomenon",
    "SELECT date_mesure::VARCHAR AS date_mesure, departement, type_phenomene FROM classified",
)
def phenomenon(t):
    return weather.classify(t.weather).select("date_mesure", "departement", "type_phenomene")


@query(
    "p24_day_class",
    """SELECT date_mesure::VARCHAR AS date_mesure, region, CASE vigilance_meteo WHEN 'ROUGE' THEN 'CRISE_METEO' WHEN 'ORANGE' THEN 'TEMPETE'
      WHEN 'JAUNE' THEN 'METEO_MODEREE' ELSE 'NORMAL' END AS classification_jour, type_phenomene FROM region_weather""",
)
def day_class(t):
    return region_weather(t).select(
        "date_mesure", "region", weather.day_class("vigilance_meteo").alias("classification_jour"), "type_phenomene"
    )


@query(
    "j14_calm_day_baseline",
    f"""SELECT k.region, round(avg(nombre_ouvertes + nombre_cloturees), 4) AS baseline_coupures FROM daily_kpi k
      LEFT JOIN region_weather w ON k.date_calcul = w.date_mesure AND k.region = w.region
    WHERE k.date_calcul BETWEEN DATE '{IMPACT_DAY}' - 30 AND DATE '{IMPACT_DAY}' - 1 AND type_reclamation = 'COUPURE_ELECTRIQUE'
      AND coalesce(vigilance_meteo, 'VERTE') NOT IN ('ORANGE', 'ROUGE') GROUP BY 1""",
)
def calm_day_baseline(t):
    return weather.outage_baseline(t.kept("daily_kpi"), region_weather(t), IMPACT_DAY)


@query(
    "a28_weather_impact",
    f"""SELECT '{IMPACT_DAY}' AS date_calcul, region, nb_coupures_jour, nb_coupures_baseline, surplus_coupures, impact_meteo_pct, vigilance_jour,
      type_phenomene, classification_jour FROM impacts""",
)
def weather_impact(t):
    return weather.impact(t.kept("daily_kpi"), region_weather(t), IMPACT_DAY)


@query(
    "a29_weather_report",
    "SELECT region, nb_coupures_jour, nb_coupures_baseline, impact_meteo_pct, classification_jour, vigilance_meteo FROM impacts",
)
def weather_report(t):
    conditions = region_weather(t)
    return weather.report(weather.impact(t.kept("daily_kpi"), conditions, IMPACT_DAY), conditions, IMPACT_DAY)


@query(
    "a54_incidents_by_weather",
    """SELECT coalesce(w.vigilance_meteo, 'VERTE') AS vigilance_meteo, count(*) AS nb_incidents, sum(nb_clients_affectes)::BIGINT AS nb_clients_affectes
    FROM merged_incidents i LEFT JOIN region_weather w ON CAST(i.date_debut_incident AS DATE) = w.date_mesure AND i.region = w.region GROUP BY 1""",
)
def incidents_by_weather(t):
    return weather.incidents_by_weather(merged(t), region_weather(t))
