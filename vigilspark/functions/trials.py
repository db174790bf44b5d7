"""Standard forms of trial fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import as_column, to_number


def phase_number(phase: Column | str) -> Column:
    """Lowest phase 1-4 named in the text, 0 when none is."""
    text = F.lower(as_column(phase).cast("string"))
    chosen = F.when(text.rlike("phase ?1"), 1)
    for number in (2, 3, 4):
        chosen = chosen.when(text.rlike(f"phase ?{number}"), number)
    return chosen.otherwise(0)


def status_category(status: Column | str) -> Column:
    text = F.lower(as_column(status).cast("string"))
    return (
        F.when(text.isNull(), "unknown")
        .when(text.contains("completed"), "completed")
        .when(text.contains("recruiting") | text.contains("active"), "active")
        .when(text.contains("terminated") | text.contains("withdrawn"), "terminated")
        .otherwise("other")
    )


def enrollment_number(enrollment: Column | str) -> Column:
    return F.coalesce(to_number(enrollment), F.lit(0.0))


def study_type(c: Column | str) -> Column:
    return F.lower(F.coalesce(as_column(c).cast("string"), F.lit("unknown")))
