"""Fixed values that decide results: codes, labels, bands, weights, topics and default parameters."""

# Seriousness flag columns of a report.
FLAG_DEATH = "seriousnessdeath"
FLAG_LIFE_THREATENING = "seriousnesslifethreatening"
FLAG_HOSPITALIZATION = "seriousnesshospitalization"
FLAG_DISABLING = "seriousnessdisabling"
FLAG_CONGENITAL = "seriousnesscongenitalanomali"

# Flags counted by the cleaner's severity score.
CLEANER_SEVERITY_FLAGS = [FLAG_DEATH, FLAG_HOSPITALIZATION, FLAG_LIFE_THREATENING, FLAG_DISABLING]

# Name fragments that mark a column as a severity column of the training table.
TRAINING_SEVERITY_TERMS = ["death", "lifethreat", "hospital", "disability"]

# Outcome codes that count as serious.
SERIOUS_OUTCOME_CODES = ["DE", "LT", "HO", "DS", "CA", "RI"]

# Brand name to generic name.
BRAND_TO_GENERIC = {
    "advil": "ibuprofen",
    "tylenol": "acetaminophen",
    "motrin": "ibuprofen",
    "aleve": "naproxen",
    "aspirin": "aspirin",
}

# Date window used when a caller leaves a bound out.
DEFAULT_WINDOW = ("20240101", "20240331")

# Age bands of the cleaner: upper edges in years, first band closed at 0.
CLEANER_AGE_EDGES = [0, 18, 35, 50, 65, 100]
CLEANER_AGE_LABELS = ["child", "young_adult", "adult", "middle_age", "senior"]

# Age and weight bands of the training table; the last band is open.
TRAINING_AGE_EDGES = [-1, 18, 40, 65, None]
TRAINING_WEIGHT_EDGES = [-1, 50, 70, 90, None]
TRAINING_BAND_CODES = [0, 1, 2, 3]
TRAINING_AGE_RISK = {0: 1, 1: 2, 2: 1, 3: 2}

# How many frequent values get a code of their own.
TOP_COUNTRIES = 5
TOP_DRUGS = 10
TOP_REACTIONS = 15

# Date features of the training table in its fixed-calendar mode.
FIXED_LAG_DAYS = 30
FIXED_MONTH = 1
FIXED_YEAR = 2024

# Columns kept by the cleaner, in order.
CLEAN_ESSENTIAL = [
    "safetyreportid", "is_serious", "serious", "receivedate", "age_group", "gender", "weight_group",
    "primary_drug", "drug_count", "primary_reaction", "reaction_count", "outcome_severity",
    "reporting_lag_days",
]
CLEAN_OPTIONAL = ["transmissiondate", "primarysourcecountry", "occurcountry"]

# Features the classifiers read, in the order they were assembled for training.
MODEL_FEATURES = [
    "reporting_lag_days", "report_month", "report_year", "weight_group", "age_group", "drug_count",
    "reaction_count", "outcome_severity", "patient_risk_score", "drug_risk_score", "occurcountry_encoded",
    "primarysourcecountry_encoded", "primary_drug_encoded", "primary_reaction_encoded",
]
TRAINING_KEYS = ["safetyreportid", "receivedate", "transmissiondate", "is_serious", "serious"]

# Rule set: (factor name, weight) for the flags, in the order they are added.
RULE_FLAGS = [
    (FLAG_DEATH, "death", 1.0),
    (FLAG_LIFE_THREATENING, "life_threatening", 0.9),
    (FLAG_HOSPITALIZATION, "hospitalization", 0.7),
    (FLAG_DISABLING, "disabling", 0.6),
    (FLAG_CONGENITAL, "birth_defect", 0.5),
]
RULE_HIGH = 0.8
RULE_MEDIUM = 0.5
RULE_MODEL_VERSION = "rule_based_v1.0"
RULE_ALERT_TYPE = "RULE_BASED"

# Model alerts.
SCORE_MODEL_VERSION = "gradient_boosting_v1.0"
SCORE_HIGH = 0.9
SCORE_REVIEW = 0.8

# Stream topics and envelope.
TOPIC_EVENTS = "adverse-events"
TOPIC_ALERTS = "safety-alerts"
STREAM_SOURCE = "FDA_FAERS_STREAM"

# FAERS text tables that are chosen unless told otherwise.
FAERS_DEFAULT_TABLES = ["DEMO", "REAC", "DRUG", "OUTC"]

# Share of rows held out for test, then share of the rest held out for validation.
TEST_SHARE = 0.10
VALIDATION_SHARE = 0.22
SEED = 42
