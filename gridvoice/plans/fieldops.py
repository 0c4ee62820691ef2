"""Field work, reconciliation, notices and delivery points."""

from pyspark.sql import functions as F

from gridvoice.operators import enrich, fieldwork, notices, reconcile
from gridvoice.plans import incidents
from gridvoice.plans.registry import query
from gridvoice.sources.conform import AS_OF, EVENTS_AS_OF, register_sql_view

RUN = "2001-08-02"
DAY = "2024-01-20"

_HOURS = """CASE type_reclamation WHEN 'COUPURE_ELECTRIQUE' THEN 48 WHEN 'RACCORDEMENT_RESEAU' THEN 360 WHEN 'INTERVENTION_TECHNIQUE' THEN 168
  WHEN 'COMPTEUR_LINKY' THEN 120 ELSE 240 END - duree_heures"""
_URGENCY = """CASE WHEN type_reclamation = 'COUPURE_ELECTRIQUE' THEN 1 WHEN type_reclamation = 'RACCORDEMENT_RESEAU' AND 360 - duree_heures < 72 THEN 2
  WHEN type_reclamation = 'INTERVENTION_TECHNIQUE' THEN 3 WHEN type_reclamation = 'COMPTEUR_LINKY' THEN 4 ELSE 5 END"""
register_sql_view(
    "unplanned",
    f"""SELECT id_reclamation, type_reclamation, region, departement, {_HOURS} AS heures_avant_sla, {_URGENCY} AS priorite_calculee
      FROM timed WHERE statut IN ('OUVERT', 'EN_COURS') AND type_reclamation IN ('COUPURE_ELECTRIQUE', 'RACCORDEMENT_RESEAU', 'INTERVENTION_TECHNIQUE', 'COMPTEUR_LINKY')
        AND id_reclamation NOT IN (SELECT id_reclamation FROM interventions WHERE statut NOT IN ('ANNULEE', 'REALISEE'))""",
)


def timed(t, geography: bool = False):
    return enrich.with_elapsed(t.tickets if geography else t.complaints, AS_OF)


@query("j08_unplanned_work", "SELECT id_reclamation, round(heures_avant_sla, 4) AS heures_avant_sla FROM unplanned")
def unplanned_work(t):
    return fieldwork.unplanned(timed(t, True), t.interventions, RUN).select("id_reclamation", "heures_avant_sla")


@query(
    "j18_active_work_only",
    """SELECT t.id_reclamation, count(i.id_intervention) AS nb_actives FROM tickets t LEFT JOIN interventions i
      ON t.id_reclamation = i.id_reclamation AND i.statut NOT IN ('ANNULEE', 'REALISEE') GROUP BY 1""",
)
def active_work_only(t):
    active = fieldwork.active_work(t.interventions).groupBy("id_reclamation").agg(
        F.count("id_intervention").alias("nb_actives")
    )
    return t.complaints.select("id_reclamation").join(active, "id_reclamation", "left").fillna(0)


@query(
    "p25_dispatch_urgency",
    f"""SELECT id_reclamation, round({_HOURS}, 4) AS heures_avant_sla, {_URGENCY} AS priorite_calculee FROM timed""",
)
def dispatch_urgency(t):
    return timed(t).select(
        "id_reclamation",
        fieldwork.hours_before_deadline().alias("heures_avant_sla"),
        fieldwork.urgency().alias("priorite_calculee"),
    )


@query(
    "a34_technician_load",
    """SELECT date_planifiee::VARCHAR AS date_calcul, technicien_id, zone_intervention, departement,
      count(*) FILTER (WHERE statut = 'PLANIFIEE') AS nb_interventions_planifiees, count(*) FILTER (WHERE priorite <= 2) AS nb_interventions_urgentes,
      round(sum(coalesce(duree_estimee_h, 2.0)), 4) AS charge_heures, round((100.0::DOUBLE * sum(coalesce(duree_estimee_h, 2.0)) / 8.0::DOUBLE)::DECIMAL(28,8), 2)::DOUBLE AS taux_charge_pct,
      round((100.0::DOUBLE * sum(coalesce(duree_estimee_h, 2.0)) / 8.0::DOUBLE)::DECIMAL(28,8), 2)::DOUBLE < 100 AS disponible
    FROM interventions GROUP BY 1, 2, 3, 4""",
)
def technician_load(t):
    return fieldwork.technician_load(t.interventions)


@query(
    "a35_dispatch_report",
    """SELECT departement, count(*) AS nb_non_planifiees, round(min(heures_avant_sla), 4) AS min_heures_avant_sla,
      count(*) FILTER (WHERE priorite_calculee = 1) AS urgents FROM unplanned GROUP BY 1""",
)
def dispatch_report(t):
    return fieldwork.dispatch_report(fieldwork.unplanned(timed(t, True), t.interventions, RUN))


# Reports already open: closed complaints of urgent priority.
register_sql_view(
    "known_findings",
    "SELECT id_reclamation, 'CRM_OMEGA_STATUT' AS type_incoherence, 'OUVERTE' AS statut FROM tickets WHERE statut = 'CLOTURE' AND priorite = 'CRITIQUE'",
)
_J15 = """SELECT 'CRM_OMEGA_STATUT' AS type_incoherence, 'CRM' AS systeme_source, 'OMEGA' AS systeme_cible, t.id_reclamation, t.client_id,
    'CRM:CLOTURE' AS valeur_source, 'OMEGA:' || i.statut AS valeur_cible, CASE WHEN i.priorite <= 2 THEN 'ELEVEE' ELSE 'MODEREE' END AS severite
  FROM timed t JOIN interventions i ON t.id_reclamation = i.id_reclamation
  WHERE t.statut = 'CLOTURE' AND i.statut IN ('PLANIFIEE', 'EN_COURS')
    AND NOT EXISTS (SELECT 1 FROM known_findings k WHERE k.id_reclamation = t.id_reclamation AND k.type_incoherence = 'CRM_OMEGA_STATUT' AND k.statut = 'OUVERTE')"""
_J16 = """SELECT 'SAP_CRM_FACTURE' AS type_incoherence, 'SAP' AS systeme_source, 'CRM' AS systeme_cible, id_reclamation, client_id,
    'SAP:correction_possible' AS valeur_source, 'CRM:' || statut AS valeur_cible, 'ELEVEE' AS severite
  FROM timed WHERE type_reclamation = 'FACTURATION' AND statut IN ('OUVERT', 'EN_COURS') AND duree_heures > 240"""
_J17 = """SELECT 'DELAI_SYNC_CRM_OMEGA' AS type_incoherence, 'CRM' AS systeme_source, 'OMEGA' AS systeme_cible, id_reclamation, client_id,
    'CRM: réclamation créée' AS valeur_source, 'OMEGA: aucune intervention' AS valeur_cible,
    CASE WHEN type_reclamation = 'COUPURE_ELECTRIQUE' THEN 'CRITIQUE' ELSE 'ELEVEE' END AS severite
  FROM timed WHERE statut IN ('OUVERT', 'EN_COURS') AND type_reclamation IN ('COUPURE_ELECTRIQUE', 'RACCORDEMENT_RESEAU', 'INTERVENTION_TECHNIQUE')
    AND duree_heures > 4 AND id_reclamation NOT IN (SELECT id_reclamation FROM interventions)"""
register_sql_view("findings", f"{_J15} UNION ALL {_J16} UNION ALL {_J17}")


def known_findings(t):
    return t.complaints.filter((F.col("statut") == "CLOTURE") & (F.col("priorite") == "CRITIQUE")).select(
        "id_reclamation", F.lit("CRM_OMEGA_STATUT").alias("type_incoherence"), F.lit("OUVERTE").alias("statut")
    )


@query("j15_closed_with_open_work", _J15)
def closed_with_open_work(t):
    return reconcile.closed_with_open_work(timed(t), t.interventions, known_findings(t))


@query("j16_overdue_billing", _J16)
def overdue_billing(t):
    return reconcile.overdue_billing(timed(t), known_findings(t))


@query("j17_work_not_created", _J17)
def work_not_created(t):
    return reconcile.work_not_created(timed(t), t.interventions, known_findings(t))


@query(
    "j27_work_without_complaint",
    """SELECT id_intervention, count(*) AS nb FROM interventions WHERE statut = 'REALISEE' AND id_reclamation NOT IN (
      SELECT id_reclamation FROM tickets WHERE type_reclamation IN ('COUPURE_ELECTRIQUE', 'RACCORDEMENT_RESEAU', 'INTERVENTION_TECHNIQUE')) GROUP BY 1""",
)
def work_without_complaint(t):
    field = t.complaints.filter(F.col("type_reclamation").isin(reconcile.CHECKED_TYPES))
    rows = reconcile.work_without_complaint(t.interventions, field)
    return rows.groupBy("id_intervention").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "u04_findings_union",
    "SELECT type_incoherence, severite, count(*) AS nb FROM findings GROUP BY 1, 2",
)
def findings_union(t):
    rows = reconcile.all_findings(timed(t), t.interventions, known_findings(t))
    return rows.groupBy("type_incoherence", "severite").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "a39_coherence_log",
    """WITH v AS (SELECT 'CRM_OMEGA' AS type_controle, count(*) AS nb_verifies FROM tickets WHERE statut = 'CLOTURE'
        AND type_reclamation IN ('COUPURE_ELECTRIQUE', 'RACCORDEMENT_RESEAU', 'INTERVENTION_TECHNIQUE')
      UNION ALL SELECT 'SAP_CRM', count(*) FROM tickets WHERE type_reclamation = 'FACTURATION' UNION ALL SELECT 'DELAI_SYNC', 0),
    i AS (SELECT CASE type_incoherence WHEN 'CRM_OMEGA_STATUT' THEN 'CRM_OMEGA' WHEN 'SAP_CRM_FACTURE' THEN 'SAP_CRM' ELSE 'DELAI_SYNC' END AS type_controle,
      count(*) AS nb FROM findings GROUP BY 1)
    SELECT type_controle, nb_verifies, coalesce(nb, 0) AS nb_incoherences,
      round((100.0::DOUBLE * (nb_verifies - coalesce(nb, 0)) / greatest(nb_verifies, 1))::DECIMAL(28,8), 2)::DOUBLE AS taux_coherence_pct FROM v LEFT JOIN i USING (type_controle)""",
)
def coherence_log(t):
    complaints = timed(t)
    return reconcile.coherence_log(complaints, reconcile.all_findings(complaints, t.interventions, known_findings(t)))


# ---- notices ---------------------------------------------------------------------

_ACK = """SELECT id_reclamation, client_id, 'ACCUSE_RECEPTION' AS type_notification_manquante, duree_heures > 240 AS echeance_depassee,
    greatest(0, duree_heures - 240) AS heures_de_retard FROM timed
  WHERE statut IN ('OUVERT', 'EN_COURS') AND duree_heures > 192 AND id_reclamation NOT IN (
    SELECT id_reclamation FROM notifications WHERE type_notification = 'ACCUSE_RECEPTION' AND statut = 'ENVOYE')"""
_RES = f"""SELECT id_reclamation, client_id, 'RESOLUTION_RECLAMATION' AS type_notification_manquante, TRUE AS echeance_depassee,
    greatest(0, duree_heures - sla_heures - 48) AS heures_de_retard FROM timed
  WHERE statut = 'CLOTURE' AND CAST(date_creation AS DATE) >= DATE '{RUN}' - 300 AND id_reclamation NOT IN (
    SELECT id_reclamation FROM notifications WHERE type_notification = 'RESOLUTION_RECLAMATION' AND statut = 'ENVOYE')"""
_SHOW = "id_reclamation, client_id, type_notification_manquante, echeance_depassee, round(heures_de_retard, 4) AS heures_de_retard"


@query("j08_missing_acknowledgements", f"SELECT {_SHOW} FROM ({_ACK})")
def missing_acknowledgements(t):
    return notices.missing_acknowledgements(timed(t), t.notifications)


@query("j08_missing_resolution_notices", f"SELECT {_SHOW} FROM ({_RES})")
def missing_resolution_notices(t):
    return notices.missing_resolution_notices(timed(t), t.notifications, RUN, 300)


register_sql_view(
    "event_elapsed",
    f"""SELECT *, (epoch_us(TIMESTAMP '{EVENTS_AS_OF}') // 1000000 - epoch_us(date_creation) // 1000000) / 3600.0::DOUBLE AS duree_heures FROM event_tickets""",
)


@query(
    "u03_missing_notice_union",
    f"""SELECT type_notification_manquante, echeance_depassee, count(*) AS nb FROM (
      SELECT 'ACCUSE_RECEPTION' AS type_notification_manquante, duree_heures > 240 AS echeance_depassee FROM event_elapsed
        WHERE statut IN ('OUVERT', 'EN_COURS') AND duree_heures > 192 AND id_reclamation NOT IN (
          SELECT id_reclamation FROM notifications WHERE type_notification = 'ACCUSE_RECEPTION' AND statut = 'ENVOYE')
      UNION ALL SELECT 'RESOLUTION_RECLAMATION', TRUE FROM event_tickets WHERE statut = 'CLOTURE' AND CAST(date_creation AS DATE) >= DATE '2024-01-30' - 3
          AND id_reclamation NOT IN (SELECT id_reclamation FROM notifications WHERE type_notification = 'RESOLUTION_RECLAMATION' AND statut = 'ENVOYE')
      UNION ALL SELECT 'INCIDENT_SYSTEMIQUE', TRUE FROM incident_links l JOIN merged_incidents m ON l.incident_id = m.incident_id
        LEFT JOIN notifications n ON n.client_id = l.client_id AND n.type_notification = 'INCIDENT_SYSTEMIQUE' AND n.date_envoi >= m.date_detection
        WHERE CAST(m.date_detection AS DATE) = DATE '2024-01-30' AND n.id IS NULL AND TIMESTAMP '{EVENTS_AS_OF}' - m.date_detection > INTERVAL 2 HOURS)
    GROUP BY 1, 2""",
)
def missing_notice_union(t):
    complaints = t.event_tickets.withColumn("date_cloture", F.lit(None).cast("timestamp"))
    rows = notices.missing_notices(
        enrich.with_elapsed(complaints, EVENTS_AS_OF),
        t.notifications,
        incidents.links(t),
        incidents.merged(t),
        "2024-01-30",
        EVENTS_AS_OF,
    )
    return rows.groupBy("type_notification_manquante", "echeance_depassee").agg(F.count(F.lit(1)).alias("nb"))


@query(
    "a36_communication_sla",
    """SELECT type_notification, sla_heures, coalesce(nb, 0) AS nb_total, coalesce(ok, 0) AS nb_dans_delai, coalesce(nb - ok, 0) AS nb_hors_delai,
      round((100.0::DOUBLE * ok / nb)::DECIMAL(28,8), 2)::DOUBLE AS taux_conformite_pct
    FROM (VALUES ('ACCUSE_RECEPTION', 240), ('COUPURE_PROGRAMMEE', 120), ('RESOLUTION_RECLAMATION', 48), ('INCIDENT_SYSTEMIQUE', 2), ('DEPASSEMENT_SLA', 24)) s(type_notification, sla_heures)
    LEFT JOIN (SELECT type_notification, count(*) AS nb, count(*) FILTER (WHERE dans_delai_legal) AS ok FROM notifications GROUP BY 1) USING (type_notification)""",
)
def communication_sla(t):
    return notices.communication_sla(t.notifications)


# ---- delivery points ---------------------------------------------------------------

_SEEN = f"""SELECT numero_compteur AS pdl_id, min(e.departement) AS departement, min(e.region) AS region FROM linky_detail d
  JOIN event_tickets e ON d.id_reclamation = e.id_reclamation WHERE numero_compteur IS NOT NULL AND export_date = DATE '{DAY}' GROUP BY 1"""


def reference_points(t):
    return t.points.withColumns(
        {"departement": F.concat(F.lit("P"), F.col("departement").cast("string")), "region": F.lit(None).cast("string")}
    )


@query(
    "j20_point_sync",
    f"""SELECT coalesce(p.pdl_id, s.pdl_id) AS pdl_id, coalesce(statut_pdl, 'ACTIF') AS statut_pdl,
      CASE WHEN s.pdl_id IS NOT NULL THEN s.departement ELSE 'P' || p.departement END AS departement,
      CASE WHEN s.pdl_id IS NOT NULL THEN '{DAY}' ELSE date_derniere_maj::VARCHAR END AS date_derniere_maj, s.region AS region
    FROM points p FULL JOIN ({_SEEN}) s ON p.pdl_id = s.pdl_id""",
)
def point_sync(t):
    seen = reconcile.points_from_meters(t.linky_detail, t.event_tickets, DAY)
    return reconcile.sync_points(reference_points(t), seen)


@query(
    "j20_complaint_links",
    f"""SELECT d.id_reclamation, numero_compteur AS pdl_id, client_id, TRUE AS concerne_pdl FROM linky_detail d
      JOIN event_tickets e ON d.id_reclamation = e.id_reclamation WHERE numero_compteur IS NOT NULL AND export_date = DATE '{DAY}'""",
)
def complaint_links(t):
    return reconcile.complaint_links(t.linky_detail, t.event_tickets, DAY)


_UNKNOWN = "SELECT pdl_id, id_reclamation, 'PDL_INCONNU' AS type_incoherence FROM complaint_points WHERE pdl_id NOT IN (SELECT pdl_id FROM points)"


@query("j08_unknown_points", _UNKNOWN)
def unknown_points(t):
    return reconcile.unknown_points(t.complaint_points, t.points)


@query(
    "j09_unreported_points",
    "SELECT pdl_id, id_reclamation FROM complaint_points WHERE pdl_id NOT IN (SELECT pdl_id FROM points) AND pdl_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def unreported_points(t):
    known = t.raw("customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("pdl_id"), F.lit("PDL_INCONNU").alias("type_incoherence"), F.lit("OUVERTE").alias("statut")
    )
    return reconcile.unknown_points(t.complaint_points, t.points, known).select("pdl_id", "id_reclamation")


_DOUBLE = "SELECT pdl_id, count(DISTINCT client_id) AS nb_clients FROM point_history WHERE is_current GROUP BY 1 HAVING count(DISTINCT client_id) > 1"


@query("a37_double_assignment", _DOUBLE)
def double_assignment(t):
    return reconcile.double_assignments(t.point_history)


@query(
    "u04_point_findings",
    f"SELECT pdl_id, id_reclamation, type_incoherence FROM ({_UNKNOWN}) UNION ALL SELECT pdl_id, NULL, 'DOUBLE_AFFECTATION' FROM ({_DOUBLE})",
)
def point_findings(t):
    return reconcile.point_findings(t.complaint_points, t.points, t.point_history)


@query(
    "j26_moved_clients",
    """SELECT id_reclamation, pdl_id, client_id FROM complaint_points c WHERE NOT EXISTS (SELECT 1 FROM point_history h
      WHERE h.pdl_id = c.pdl_id AND h.client_id = c.client_id AND CAST(c.date_creation AS DATE) >= h.date_debut
        AND (h.date_fin IS NULL OR CAST(c.date_creation AS DATE) <= h.date_fin))""",
)
def moved_clients(t):
    return reconcile.moved_clients(t.complaint_points, t.point_history).select("id_reclamation", "pdl_id", "client_id")


@query(
    "a38_point_stats",
    f"""SELECT (SELECT count(*) FROM points) AS total_pdl, (SELECT count(*) FROM points WHERE statut_pdl = 'ACTIF') AS pdl_actifs,
      (SELECT count(*) FROM ({_UNKNOWN})) + (SELECT count(*) FROM ({_DOUBLE})) AS incoherences_ouvertes""",
)
def point_stats(t):
    findings = reconcile.point_findings(t.complaint_points, t.points, t.point_history)
    return reconcile.point_stats(t.points, findings)
