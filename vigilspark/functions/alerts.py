"""Alert fields derived from a model's probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def score_level(p_serious: Column) -> Column:
    return F.when(p_serious > K.SCORE_HIGH, "HIGH").otherwise("MEDIUM")


def needs_review(p_serious: Column) -> Column:
    return F.when(p_serious > K.SCORE_REVIEW, 1).otherwise(0)


def is_confident(p_serious: Column) -> Column:
    """1 when the likelier class has more than the review probability."""
    return F.when(F.greatest(p_serious, 1 - p_serious) > K.SCORE_REVIEW, 1).otherwise(0)


def score_label(prediction: Column) -> Column:
    return F.when(prediction == 1, "SERIOUS").otherwise("NON_SERIOUS")


def score_message(p_serious: Column, severity: Column, drug_count: Column, patient_risk: Column) -> Column:
    def suffix(condition: Column, text: str) -> Column:
        return F.when(condition, F.lit(text)).otherwise(F.lit(""))

    return F.concat(
        F.format_string("SERIOUS ADVERSE EVENT DETECTED (Confidence: %.1f%%)", p_serious * 100),
        suffix(severity >= 3, " - High outcome severity"),
        suffix(drug_count > 2, " - Multiple drugs involved"),
        suffix(patient_risk > 1.5, " - High-risk patient"),
    )
