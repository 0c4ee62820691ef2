"""Fixed values of the business domain.

Every list, threshold and pattern below must equal the published business
rules for the results to be right, so they are stated here once, as plain data.
"""

# Complaint domains.
TYPES = [
    "COUPURE_ELECTRIQUE",
    "COMPTEUR_LINKY",
    "FACTURATION",
    "RACCORDEMENT_RESEAU",
    "INTERVENTION_TECHNIQUE",
]
STATUSES = ["OUVERT", "EN_COURS", "CLOTURE", "ESCALADE"]
OPEN_STATUSES = ["OUVERT", "EN_COURS"]
PRIORITIES = ["CRITIQUE", "HAUTE", "NORMALE", "BASSE"]

# Resolution deadline per complaint type, in hours.
SLA_HOURS = {
    "COUPURE_ELECTRIQUE": 48,
    "COMPTEUR_LINKY": 120,
    "FACTURATION": 240,
    "RACCORDEMENT_RESEAU": 360,
    "INTERVENTION_TECHNIQUE": 168,
}
SLA_DEFAULT = 168
SLA_UNKNOWN = 9999

# Hours left below which an open complaint is at risk, per specialised type.
RISK_HOURS = {
    "COUPURE_ELECTRIQUE": 12,
    "FACTURATION": 24,
    "RACCORDEMENT_RESEAU": 48,
}

# Base priority score.
PRIORITY_SCORE = {"CRITIQUE": 100, "HAUTE": 75, "NORMALE": 50, "BASSE": 25}
PRIORITY_SCORE_DEFAULT = 50

# Meters.
METER_REFERENCE = "^LKY[0-9]{8}$"
METER_POWERS = [3, 6, 9, 12, 15, 18, 24, 36]

# Columns whose absence counts against completeness.
REQUIRED_COLUMNS = [
    "id_reclamation",
    "client_id",
    "type_reclamation",
    "statut",
    "priorite",
    "region",
    "date_creation",
]
QUALITY_WEIGHTS = {"completude": 0.3, "unicite": 0.3, "validite": 0.2, "coherence": 0.2}
QUALITY_PASS = 90.0

# Minimum quality rates per layer.
LAYER_THRESHOLDS = {
    "bronze": {"completeness": 0.70, "validity": 0.80, "consistency": 0.75},
    "silver": {"completeness": 0.90, "validity": 0.95, "consistency": 0.90, "uniqueness": 0.98},
    "gold": {
        "completeness": 0.98,
        "validity": 0.99,
        "consistency": 0.98,
        "uniqueness": 0.99,
        "accuracy": 0.95,
    },
}
LAYER_RETENTION_DAYS = {"bronze": 730, "silver": 365, "gold": 90}

# Weather thresholds: gust m/s, rain mm/day, snow cm, temperature in Celsius.
WEATHER_RED = {"rafales": 28, "pluie": 50, "neige": 20}
WEATHER_ORANGE = {"rafales": 20, "pluie": 30, "neige": 10}
WEATHER_YELLOW = {"rafales": 15, "pluie": 15}
HEAT_C = 35
FROST_C = -5

# Regulatory limits.
SAIDI_MAX_MINUTES_PER_YEAR = 60
CONNECTION_RATE_MIN = 90.0
CONNECTION_DELAY_DAYS = 30
COMMISSIONING_DELAY_DAYS = 7

# Meter-fraud scoring.
FRAUD_TYPE_WEIGHT = {"CONSO_PENDANT_COUPURE": 40, "DELTA_INDEX": 25, "CONSO_NULLE": 15}
FRAUD_TYPE_DEFAULT = 10
FRAUD_SEVERITY_WEIGHT = {"CRITIQUE": 2.0, "ELEVEE": 1.5, "MODEREE": 1.0}
FRAUD_SEVERITY_DEFAULT = 0.5
INDEX_DELTA_PCT = 5.0
ZERO_DAYS = 7
PEAK_SIGMA = 3.0
REPORTABLE_ANOMALIES = 3

# Outage clusters: distinct customers.
CLUSTER_MIN_CLIENTS = 10
CLUSTER_SEVERITY = [(500, "CRITIQUE"), (100, "MAJEUR"), (30, "MODERE")]
CLUSTER_SEVERITY_DEFAULT = "MINEUR"

# Communication deadlines per notice type, in hours.
NOTICE_SLA = {
    "ACCUSE_RECEPTION": 240,
    "COUPURE_PROGRAMMEE": 120,
    "RESOLUTION_RECLAMATION": 48,
    "INCIDENT_SYSTEMIQUE": 2,
    "DEPASSEMENT_SLA": 24,
}

# Complaint load: normal volume per day and the ratio from which each level starts.
BASELINE_PER_DAY = 20_000
LOAD_LEVELS = [(10.0, "CRISE", 3), (5.0, "CRITIQUE", 2), (2.0, "ELEVE", 1)]

# Free-text categories, tried in this order.
TEXT_CATEGORIES = [
    ("COMPTEUR_LINKY", ["linky", "compteur"]),
    ("COUPURE_ELECTRIQUE", ["coupure", "panne"]),
    ("FACTURATION", ["facture", "montant"]),
    ("RACCORDEMENT", ["raccordement", "travaux"]),
]

# Postcode zones.
POSTCODE_ZONES = [
    ("PARIS_CENTRE", "75000", "75999"),
    ("YVELINES", "78000", "78999"),
    ("HAUTS_DE_SEINE", "92000", "92999"),
]
