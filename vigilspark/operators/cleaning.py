"""Report and trial cleaning, and the feature table built from cleaned reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import bands, dates, risk, trials
from ..functions.coerce import equals_one
from .columns import fill_zero, has_any, keep_existing, named, with_numbers
from .encoding import one_hot

DATE_COLUMNS = ["receivedate", "transmissiondate", "receiptdate"]
UNKNOWN = "unknown"


def clean_dates(reports: DataFrame) -> DataFrame:
    """Add ``<column>_clean`` dates for the date columns present."""
    return reports.withColumns({f"{c}_clean": dates.report_day(c) for c in has_any(reports, DATE_COLUMNS)})


def clean_reports(reports: DataFrame) -> DataFrame:
    """Cleaned reports: target, demographic groups, counts, severity and reporting lag.

    Patient details are read only where the input still has its ``patient`` column; flattened inputs get the
    'unknown' groups and zero counts.
    """
    have = set(reports.columns)
    has_patient = "patient" in have
    flags = has_any(reports, K.CLEANER_SEVERITY_FLAGS)
    out = with_numbers(clean_dates(reports), ["serious", "patientonsetage", *flags])
    serious = F.col("_n_serious") if "serious" in have else F.lit(None).cast("double")
    derived = {"is_serious": equals_one(serious)}
    if "serious" in have:
        derived["serious"] = serious
    derived["age_group"] = (
        bands.age_group_label(F.col("_n_patientonsetage"))
        if has_patient and "patientonsetage" in have else F.lit(UNKNOWN)
    )
    for name in ("gender", "weight_group", "primary_drug", "primary_reaction"):
        derived[name] = F.lit(UNKNOWN)
    for name in ("drug_count", "reaction_count"):
        derived[name] = F.lit(1 if has_patient else 0)
    derived["outcome_severity"] = risk.severity_count([F.col(f"_n_{c}") for c in flags])
    derived["reporting_lag_days"] = (
        dates.lag_days(F.col("receivedate_clean"), F.col("receiptdate_clean"))
        if {"receivedate", "receiptdate"} <= have else F.lit(0)
    )
    return keep_existing(out.withColumns(derived), K.CLEAN_ESSENTIAL, K.CLEAN_OPTIONAL)


def cleaner_domains(cleaned_with_patient: bool) -> dict[str, list[str]]:
    """Values each one-hot feature of the cleaner can take."""
    ages = K.CLEANER_AGE_LABELS if cleaned_with_patient else [UNKNOWN]
    return {"age_group": ages, "gender": [UNKNOWN], "primary_drug": [UNKNOWN], "primary_reaction": [UNKNOWN]}


def features_v1(cleaned: DataFrame, with_patient: bool) -> DataFrame:
    """Feature table of the cleaner: one-hot groups, risk scores, report month and year, no missing values."""
    received = F.col("_received")
    scored = cleaned.withColumn("_received", dates.report_day("receivedate")).withColumns({
        "patient_risk_score": risk.patient_risk_from_groups(F.col("age_group"), F.col("outcome_severity")),
        "drug_risk_score": risk.drug_risk_from_count(F.col("drug_count")),
        "report_month": dates.report_month(received),
        "report_year": dates.report_year(received),
    }).drop("_received")
    for feature, domain in cleaner_domains(with_patient).items():
        scored = one_hot(scored, feature, domain)
    scores = ["patient_risk_score", "drug_risk_score", "report_month", "report_year"]
    ordered = [c for c in scored.columns if c not in scores] + scores
    return fill_zero(scored.select(*[named(c) for c in ordered]))


def clean_trials(trials_df: DataFrame) -> DataFrame:
    """Trials with numeric phase and enrollment, status category, lower-case type and years."""
    have = set(trials_df.columns)
    derived = {
        "phase_numeric": trials.phase_number("phase") if "phase" in have else F.lit(0),
        "enrollment_clean": trials.enrollment_number("enrollment") if "enrollment" in have else F.lit(0.0),
        "status_category": trials.status_category("overallStatus") if "overallStatus" in have else F.lit(UNKNOWN),
        "study_type_clean": trials.study_type("studyType") if "studyType" in have else F.lit(UNKNOWN),
    }
    for column in has_any(trials_df, ["startDate", "completionDate"]):
        derived[f"{column}_year"] = dates.study_year(column)
    return trials_df.withColumns(derived)


def type_census(df: DataFrame) -> tuple[int, int]:
    """How many columns are numeric and how many are text."""
    kinds = [f.dataType for f in df.schema.fields]
    return (
        sum(isinstance(k, T.NumericType) for k in kinds),
        sum(isinstance(k, T.StringType) for k in kinds),
    )
