"""The 19-column training table and the feature defaults used at scoring time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import bands, dates, risk
from ..functions.coerce import is_serious_text
from .columns import columns_naming, fill_zero, named, number, with_numbers
from .encoding import dictionaries, top_n_codes
from .nested import flatten_first


@dataclass(frozen=True)
class TrainingColumns:
    """Where the training table finds the patient fields in a flattened report."""

    weight: str = "patient_patientweight"
    age: str = "patient_patientage"
    drug: str = "patient_drug_medicinalproduct"
    reaction: str = "patient_reaction_reactionmeddrapt"


def present_count(df: DataFrame, term: str) -> Column:
    """How many columns with the term in their name hold a value; 1 where no column has it."""
    names = columns_naming(df, [term])
    if not names:
        return F.lit(1)
    return reduce(add, [named(n).isNotNull().cast("int") for n in names])


def column_counts(df: DataFrame) -> dict[str, Column]:
    return {"drug_count": present_count(df, "drug"), "reaction_count": present_count(df, "reaction")}


def training_severity(df: DataFrame) -> Column:
    return risk.severity_sum([number(df, n) for n in columns_naming(df, K.TRAINING_SEVERITY_TERMS)])


def features_v2(
    reports: DataFrame,
    columns: TrainingColumns = TrainingColumns(),
    calendar: str = "fixed",
    counts: str = "columns",
) -> DataFrame:
    """The training table, always with the same 19 columns.

    ``calendar='fixed'`` sets lag, month and year to constants; 'actual' derives them from the dates.
    ``counts='columns'`` counts filled columns by name; 'given' takes the input's own ``drug_count`` and
    ``reaction_count``.
    """
    have = set(reports.columns)
    severity = columns_naming(reports, K.TRAINING_SEVERITY_TERMS)
    tallied = ["drug_count", "reaction_count"] if counts == "given" else []
    rows = with_numbers(reports, ["serious", columns.age, columns.weight, *tallied, *severity])

    def or_null(name: str) -> Column:
        return named(name) if name in have else F.lit(None).cast("string")

    def number_or_null(name: str) -> Column:
        return named(f"_n_{name}") if name in have else F.lit(None).cast("double")

    id_column = next((c for c in ("safetyreportid", "safetyreportversion") if c in have), None)
    fixed = calendar == "fixed"
    if not fixed:
        rows = rows.withColumns({
            "_received": dates.report_day(or_null("receivedate")),
            "_receipt": dates.report_day(or_null("receiptdate")),
        })
    received, receipt = F.col("_received"), F.col("_receipt")
    tallies = (
        column_counts(reports) if counts == "columns"
        else {c: F.coalesce(number_or_null(c).cast("int"), F.lit(1)) for c in tallied}
    )
    sizes = {
        "occurcountry": K.TOP_COUNTRIES,
        "primarysourcecountry": K.TOP_COUNTRIES,
        columns.drug: K.TOP_DRUGS,
        columns.reaction: K.TOP_REACTIONS,
    }
    coded = {c: n for c, n in sizes.items() if c in have}
    if coded:
        rows = rows.withColumn("_known", dictionaries(reports, coded))
    codes = top_n_codes(F.col("_known"), coded)

    base = rows.select(
        (named(id_column) if id_column else F.lit("")).alias("safetyreportid"),
        (is_serious_text("serious") if "serious" in have else F.lit(0)).alias("is_serious"),
        number_or_null("serious").alias("serious"),
        or_null("receivedate").alias("receivedate"),
        or_null("transmissiondate").alias("transmissiondate"),
        (F.lit(K.FIXED_LAG_DAYS) if fixed else dates.lag_days(received, receipt)).alias("reporting_lag_days"),
        (F.lit(K.FIXED_MONTH) if fixed else dates.report_month(received)).alias("report_month"),
        (F.lit(K.FIXED_YEAR) if fixed else dates.report_year(received)).alias("report_year"),
        bands.weight_group_code(number_or_null(columns.weight)).alias("weight_group"),
        bands.age_group_code(number_or_null(columns.age)).alias("age_group"),
        tallies["drug_count"].alias("drug_count"),
        tallies["reaction_count"].alias("reaction_count"),
        risk.severity_sum([named(f"_n_{n}") for n in severity]).alias("outcome_severity"),
        *[
            codes.get(source, F.lit(0)).alias(target)
            for source, target in zip(
                sizes,
                ("occurcountry_encoded", "primarysourcecountry_encoded", "primary_drug_encoded",
                 "primary_reaction_encoded"),
            )
        ],
    )
    scored = base.withColumns({
        "patient_risk_score": risk.patient_risk_from_codes(F.col("age_group"), F.col("reaction_count")),
        "drug_risk_score": risk.drug_risk_clipped(F.col("drug_count")),
    })
    order = [
        "safetyreportid", "is_serious", "serious", "receivedate", "transmissiondate", *K.MODEL_FEATURES,
    ]
    return fill_zero(scored.select(*order), skip=["safetyreportid", "receivedate", "transmissiondate"])


NESTED_COLUMNS = TrainingColumns(
    weight="patient_patientweight", age="patient_patientonsetage", drug="first_product", reaction="first_term"
)


def training_table(reports: DataFrame, calendar: str = "actual") -> DataFrame:
    """The training table straight from nested reports: first drug and reaction, and true counts of both."""
    patient = named("patient")
    drugs, reactions = patient["drug"], patient["reaction"]
    flat = flatten_first(reports.withColumns({
        "first_product": F.get(drugs, 0)["medicinalproduct"],
        "first_term": F.get(reactions, 0)["reactionmeddrapt"],
        "drug_count": F.coalesce(F.array_size(drugs), F.lit(0)),
        "reaction_count": F.coalesce(F.array_size(reactions), F.lit(0)),
    }))
    return features_v2(flat, NESTED_COLUMNS, calendar, counts="given")


def bin_violations(reports: DataFrame, columns: TrainingColumns = TrainingColumns()) -> DataFrame:
    """How many ages and weights lie below the lowest band edge and so get no code."""
    low = K.TRAINING_AGE_EDGES[0]
    return reports.agg(
        F.count_if(number(reports, columns.age) < low).alias("age_below_bands"),
        F.count_if(number(reports, columns.weight) < low).alias("weight_below_bands"),
    )


def score_features(events: DataFrame) -> DataFrame:
    """The model's features as doubles; absent, missing, NaN and unreadable values become 0."""
    have = set(events.columns)
    return events.withColumns({
        name: F.coalesce(number(events, name), F.lit(0.0)) if name in have else F.lit(0.0)
        for name in K.MODEL_FEATURES
    })
