"""Cutting numbers into bands that are closed on the right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def band(value: Column, edges: Sequence[float | None], labels: Sequence) -> Column:
    """Label of the band the value falls in, null outside all bands.

    ``edges`` has one entry more than ``labels``; the lowest edge belongs to the first band and a last edge
    of None leaves that band open.
    """
    chosen = F.when(value < edges[0], F.lit(None))
    for upper, label in zip(edges[1:], labels):
        chosen = chosen.when(value.isNotNull() if upper is None else value <= upper, F.lit(label))
    return chosen


def age_group_label(age_number: Column) -> Column:
    """Cleaner's age group; an age outside the bands, or none, gives the text 'nan'."""
    return F.coalesce(band(age_number, K.CLEANER_AGE_EDGES, K.CLEANER_AGE_LABELS), F.lit("nan"))


def age_group_code(age_number: Column) -> Column:
    """Training age code; a missing age counts as 0 years, an age below -1 has no code."""
    return band(F.coalesce(age_number, F.lit(0.0)), K.TRAINING_AGE_EDGES, K.TRAINING_BAND_CODES)


def weight_group_code(weight_number: Column) -> Column:
    return band(F.coalesce(weight_number, F.lit(0.0)), K.TRAINING_WEIGHT_EDGES, K.TRAINING_BAND_CODES)
