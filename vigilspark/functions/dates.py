"""Report dates (yyyyMMdd text) and free-form study dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import WHITESPACE, as_column


def strip(c: Column | str) -> Column:
    return F.btrim(as_column(c).cast("string"), F.lit(WHITESPACE))


def report_day(c: Column | str) -> Column:
    """Date of exactly eight digits; anything else, or a day no calendar has, is null."""
    text = strip(c)
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))


def lag_days(received: Column, receipt: Column) -> Column:
    """Days from receipt to receive date; 0 where either is missing."""
    return F.coalesce(F.datediff(received, receipt), F.lit(0))


def report_month(received: Column) -> Column:
    return F.coalesce(F.month(received), F.lit(0))


def report_year(received: Column) -> Column:
    return F.coalesce(F.year(received), F.lit(0))


def study_year(c: Column | str) -> Column:
    """First run of four digits if it is a plausible year; later runs are not tried."""
    year = F.regexp_extract(as_column(c).cast("string"), r"([0-9]{4})", 1).try_cast("int")
    return F.when(year.between(1990, 2030), year)
