"""Reading numbers and flags out of loosely typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\x0b"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_nan(c: Column | str) -> Column:
    """NaN becomes null, so that ``coalesce`` and aggregates treat it as missing."""
    return F.nanvl(as_column(c).cast("double"), F.lit(None).cast("double"))


def to_number(c: Column | str) -> Column:
    """Text to double; text that is no number, and NaN, become null.

    Java reads a trailing type letter as part of a number, so "5d" would count as 5. Appending that letter
    makes such text unreadable and leaves plain numbers as they are; infinities are named apart.
    """
    text = F.btrim(as_column(c).cast("string"), F.lit(WHITESPACE))
    low = F.lower(text)
    infinite = F.when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))).when(
        low.isin("-inf", "-infinity"), F.lit(float("-inf"))
    )
    return F.coalesce(F.concat(text, F.lit("d")).try_cast("double"), infinite)


def equals_one(number: Column) -> Column:
    """1 where the number is 1, else 0; null counts as 0."""
    return F.coalesce((number == 1).cast("int"), F.lit(0))


def is_serious_numeric(serious: Column | str) -> Column:
    return equals_one(to_number(serious))


def is_serious_text(serious: Column | str) -> Column:
    """1 only for the exact text '1', so '1.0' counts as not serious."""
    return F.coalesce((as_column(serious).cast("string") == "1").cast("int"), F.lit(0))
