"""Severity counts and the two families of risk scores."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .coerce import equals_one


def severity_count(flag_numbers: list[Column]) -> Column:
    """How many flags equal 1."""
    return reduce(add, [equals_one(n) for n in flag_numbers], F.lit(0))


def severity_sum(flag_numbers: list[Column]) -> Column:
    """Sum of the flags' integer values, so a flag coded '2' adds 2."""
    return reduce(add, [F.coalesce(n.try_cast("int"), F.lit(0)) for n in flag_numbers], F.lit(0))


def patient_risk_from_groups(age_group: Column, severity: Column) -> Column:
    senior = F.when(age_group == "senior", F.lit(0.3)).otherwise(F.lit(0.0))
    middle = F.when(age_group == "middle_age", F.lit(0.2)).otherwise(F.lit(0.0))
    return senior + middle + severity * F.lit(0.5)


def drug_risk_from_count(drug_count: Column) -> Column:
    return F.lit(1.0) + (drug_count - 1) * F.lit(0.1)


def _clip_to_two(c: Column) -> Column:
    return F.greatest(F.least(c, F.lit(2.0)), F.lit(0.0))


def patient_risk_from_codes(age_code: Column, reaction_count: Column) -> Column:
    age_risk = F.lit(1)
    for code, risk in K.TRAINING_AGE_RISK.items():
        age_risk = F.when(age_code == code, F.lit(risk)).otherwise(age_risk)
    return (age_risk.cast("double") + _clip_to_two(reaction_count.cast("double") / 5)) / 2


def drug_risk_clipped(drug_count: Column) -> Column:
    return _clip_to_two(drug_count.cast("double") / 3)
