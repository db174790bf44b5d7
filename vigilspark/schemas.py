"""Declared schemas of landed files, stream messages and stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from .constants import MODEL_FEATURES


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


REPORT_FLAT = T.StructType(_strings(
    "safetyreportid", "safetyreportversion", "serious", "seriousnessdeath", "seriousnesshospitalization",
    "seriousnesslifethreatening", "seriousnessdisabling", "seriousnesscongenitalanomali", "seriousnessother",
    "receivedate", "receiptdate", "transmissiondate", "primarysourcecountry", "occurcountry", "companynumb", "duplicate",
    "reporttype",
))

PATIENT = T.StructType(
    _strings("patientonsetage", "patientweight", "patientsex")
    + [
        T.StructField("drug", T.ArrayType(T.StructType(_strings("medicinalproduct")))),
        T.StructField("reaction", T.ArrayType(T.StructType(_strings("reactionmeddrapt")))),
    ]
)

REPORT_NESTED = T.StructType(REPORT_FLAT.fields + [
    T.StructField("primarysource", T.StructType(_strings("qualification", "reportercountry"))),
    T.StructField("reportduplicate", T.ArrayType(T.StructType(_strings("duplicatesource", "duplicatenumb")))),
    T.StructField("patient", PATIENT),
])

REPORT_PAGE = T.StructType([T.StructField("results", T.ArrayType(REPORT_NESTED))])

_DATE = T.StructType(_strings("date"))

STUDY = T.StructType([
    T.StructField("protocolSection", T.StructType([
        T.StructField("identificationModule", T.StructType(_strings("nctId", "briefTitle"))),
        T.StructField("designModule", T.StructType([
            T.StructField("phases", T.ArrayType(T.StringType())),
            T.StructField("studyType", T.StringType()),
            T.StructField("enrollmentInfo", T.StructType([T.StructField("count", T.LongType())])),
        ])),
        T.StructField("statusModule", T.StructType([
            T.StructField("overallStatus", T.StringType()),
            T.StructField("startDateStruct", _DATE),
            T.StructField("primaryCompletionDateStruct", _DATE),
        ])),
        T.StructField("armsInterventionsModule", T.StructType([
            T.StructField("interventions", T.ArrayType(T.StructType(_strings("name")))),
        ])),
        T.StructField("conditionsModule", T.StructType([
            T.StructField("conditions", T.ArrayType(T.StringType())),
        ])),
    ])),
])

STUDY_PAGE = T.StructType([T.StructField("studies", T.ArrayType(STUDY))])

# Stream messages keep every feature as text, so that one unreadable number does not lose the message.
EVENT_MESSAGE = T.StructType(
    _strings("event_id", "safetyreportid", "is_serious", "timestamp", "source") + _strings(*MODEL_FEATURES)
)

_INT, _DOUBLE, _STRING, _DAY, _TS = T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampType()


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


ADVERSE_EVENTS = _table(
    ("event_id", _STRING), ("safetyreportid", _STRING), ("safetyreportversion", _STRING),
    ("receivedate", _DAY), ("receiptdate", _DAY), ("serious", _INT),
    ("seriousnesscongenitalanomali", _INT), ("seriousnessdeath", _INT), ("seriousnessdisabling", _INT),
    ("seriousnesshospitalization", _INT), ("seriousnesslifethreatening", _INT), ("seriousnessother", _INT),
    ("transmissiondate", _DAY), ("duplicate", _INT), ("companynumb", _STRING),
    ("occurcountry_encoded", _INT), ("primarysource_encoded", _INT), ("primarysourcecountry_encoded", _INT),
    ("reporttype_encoded", _INT), ("drug_count", _INT), ("reaction_count", _INT), ("patient_age", _DOUBLE),
    ("patient_weight", _DOUBLE), ("patient_sex_encoded", _INT), ("outcome_severity", _INT),
    ("patient_risk_score", _DOUBLE), ("time_to_onset_days", _DOUBLE), ("concomitant_drug_risk", _DOUBLE),
    ("raw_data", _STRING), ("created_at", _TS), ("updated_at", _TS),
)

SAFETY_ALERTS = _table(
    ("alert_id", _STRING), ("event_id", _STRING), ("alert_type", _STRING), ("alert_level", _STRING),
    ("prediction_probability", _DOUBLE), ("model_version", _STRING), ("alert_message", _STRING),
    ("alert_data", _STRING), ("is_reviewed", T.BooleanType()), ("reviewed_by", _STRING),
    ("reviewed_at", _TS), ("created_at", _TS),
)

MODEL_PERFORMANCE = _table(
    ("model_name", _STRING), ("model_version", _STRING), ("accuracy", _DOUBLE), ("precision_score", _DOUBLE),
    ("recall", _DOUBLE), ("f1_score", _DOUBLE), ("roc_auc", _DOUBLE), ("training_date", _TS),
    ("feature_importance", _STRING), ("performance_data", _STRING), ("created_at", _TS),
)

SYSTEM_METRICS = _table(
    ("metric_name", _STRING), ("metric_value", _DOUBLE), ("metric_unit", _STRING), ("component", _STRING),
    ("timestamp", _TS), ("additional_data", _STRING),
)

STORE_TABLES = {
    "adverse_events": ADVERSE_EVENTS,
    "safety_alerts": SAFETY_ALERTS,
    "model_performance": MODEL_PERFORMANCE,
    "system_metrics": SYSTEM_METRICS,
}
