"""Additive risk rules as column expressions, usable on batch and streaming rows alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def rule_terms(
    flags: dict[str, Column], age: Column, drug_count: Column, reaction_count: Column, severity: Column
) -> list[tuple[Column, list[tuple[Column, str, float]]]]:
    """The rule set in scoring order.

    Each rule is a list of exclusive cases (condition, factor name, weight); the first case that holds
    applies.
    """
    rules = [[(flags[column] == 1, factor, weight)] for column, factor, weight in K.RULE_FLAGS]
    rules.append([(age > 65, "elderly", 0.2), ((age < 18) & (age > 0), "pediatric", 0.25)])
    rules.append([(drug_count > 5, "multiple_drugs", 0.3), (drug_count > 3, "several_drugs", 0.15)])
    rules.append([(reaction_count > 3, "multiple_reactions", 0.2)])
    rules.append([(severity > 7, "high_severity_score", 0.3)])
    return rules


def _case(cases: list[tuple[Column, str, float]], pick) -> Column:
    condition, factor, weight = cases[0]
    chosen = F.when(condition, F.lit(pick(factor, weight)))
    for condition, factor, weight in cases[1:]:
        chosen = chosen.when(condition, F.lit(pick(factor, weight)))
    return chosen


def risk_score(rules) -> Column:
    """Sum of the applying weights in rule order, capped at 1."""
    total = F.lit(0.0)
    for cases in rules:
        total = total + F.coalesce(_case(cases, lambda _, weight: float(weight)), F.lit(0.0))
    return F.least(total, F.lit(1.0))


def risk_factors(rules) -> Column:
    """Names of the applying rules in rule order."""
    return F.array_compact(F.array(*[_case(cases, lambda factor, _: factor) for cases in rules]))


def risk_level(score: Column) -> Column:
    return F.when(score >= K.RULE_HIGH, "HIGH").when(score >= K.RULE_MEDIUM, "MEDIUM").otherwise("LOW")


def risk_prediction(score: Column) -> Column:
    return F.when(score >= K.RULE_MEDIUM, 1).otherwise(0)


def rule_message(level: Column, factors: Column) -> Column:
    return F.concat(F.lit("Rule-based alert: "), level, F.lit(" risk - "), F.array_join(factors, ", "))
