"""Rule-based assessment of events, and the rows it leaves in the store. Works on batch and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rules
from ..functions.coerce import equals_one
from .columns import named, number

# Number an absent or missing value stands for.
_DEFAULTS = {"patient_age": 0.0, "drug_count": 1.0, "reaction_count": 1.0, "outcome_severity": 0.0}


def _with_rule_inputs(events: DataFrame) -> DataFrame:
    """Add the numbers the rules read as ``_r_`` columns; absent and missing values take their defaults."""
    have = set(events.columns)
    inputs = {
        f"_r_{column}": equals_one(number(events, column)) if column in have else F.lit(0)
        for column, _, _ in K.RULE_FLAGS
    }
    for name, default in _DEFAULTS.items():
        inputs[f"_r_{name}"] = F.coalesce(number(events, name), F.lit(default)) if name in have else F.lit(default)
    return events.withColumns(inputs)


def stable_event_id(events: DataFrame) -> Column:
    """The event's id, or one made from its content so that event and alert rows always agree."""
    made = F.concat(F.lit("rule_"), F.hex(F.xxhash64(*[named(c) for c in events.columns])))
    return F.coalesce(named("event_id").cast("string"), made) if "event_id" in events.columns else made


def assess(events: DataFrame) -> DataFrame:
    """Add score, level, prediction, factor list and rule version to every event."""
    rule_set = rules.rule_terms(
        {column: F.col(f"_r_{column}") for column, _, _ in K.RULE_FLAGS}, *[F.col(f"_r_{n}") for n in _DEFAULTS]
    )
    prepared = _with_rule_inputs(events)
    scored = prepared.withColumns({
        "risk_score": rules.risk_score(rule_set),
        "risk_factors": rules.risk_factors(rule_set),
    }).drop(*[c for c in prepared.columns if c.startswith("_r_")])
    return scored.withColumns({
        "alert_level": rules.risk_level(F.col("risk_score")),
        "prediction": rules.risk_prediction(F.col("risk_score")),
        "model_version": F.lit(K.RULE_MODEL_VERSION),
    })


def assessed_with_source(events: DataFrame) -> DataFrame:
    """Assessment plus a stable event id and the original event as JSON."""
    original = F.to_json(F.struct(*[named(c) for c in events.columns]))
    return assess(events).withColumns({"event_id": stable_event_id(events), "raw_data": original})


def rule_event_rows(assessed: DataFrame, now: Column | None = None, *keep: str) -> DataFrame:
    """Rows for the event table out of ``assessed_with_source``, with the columns to keep beside them."""
    report_id = F.col("safetyreportid").cast("string") if "safetyreportid" in assessed.columns else F.lit(None)
    return assessed.select(
        "event_id",
        F.coalesce(report_id, F.lit("UNKNOWN")).alias("safetyreportid"),
        F.col("prediction").alias("serious"),
        (F.col("risk_score") * 10).cast("int").alias("outcome_severity"),
        F.col("risk_score").alias("patient_risk_score"),
        "raw_data",
        (F.current_timestamp() if now is None else now).alias("created_at"),
        *keep,
    )


def rule_alert_gate(assessed: DataFrame) -> DataFrame:
    return assessed.where(F.col("risk_score") >= K.RULE_MEDIUM)


def rule_alerts(assessed: DataFrame, now: Column | None = None, *keep: str) -> DataFrame:
    """Alert rows for events that reach the alert threshold."""
    stamp = F.current_timestamp() if now is None else now
    assessment = F.struct(
        "prediction", "risk_score", "alert_level", "risk_factors", "model_version",
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    return rule_alert_gate(assessed).select(
        F.concat(F.lit("RULE_ALERT_"), F.col("event_id")).alias("alert_id"),
        "event_id",
        F.lit(K.RULE_ALERT_TYPE).alias("alert_type"),
        "alert_level",
        F.col("risk_score").alias("prediction_probability"),
        "model_version",
        rules.rule_message(F.col("alert_level"), F.col("risk_factors")).alias("alert_message"),
        F.to_json(assessment).alias("alert_data"),
        stamp.alias("created_at"),
        *keep,
    )
