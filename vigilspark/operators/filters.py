"""Report searches: date windows, terms, caps, fallback and balanced collection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .columns import named
from .ranking import first_rows


def window_bounds(start: str | None, end: str | None) -> tuple[str, str]:
    """Both bounds as given, or the default window when either is missing."""
    return (start, end) if start and end else K.DEFAULT_WINDOW


def in_receive_window(start: str | None = None, end: str | None = None) -> Column:
    return F.col("receivedate").between(*window_bounds(start, end))


def filter_receive_window(reports: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Reports received in the window, both ends included; text order of yyyyMMdd is date order."""
    return reports.where(in_receive_window(start, end))


def term_condition(terms: list[str]) -> Column:
    """``field:value`` terms, all of which must hold."""
    parts = [term.partition(":") for term in terms]
    return reduce(and_, [named(field.strip()) == value.strip().strip('"') for field, _, value in parts], F.lit(True))


def filter_search_terms(reports: DataFrame, terms: list[str]) -> DataFrame:
    return reports.where(term_condition(terms))


def filter_serious(reports: DataFrame, serious: bool = True) -> DataFrame:
    return reports.where(F.col("serious") == ("1" if serious else "2"))


def limit_reports(reports: DataFrame, limit: int = 100) -> DataFrame:
    """First page of a search: the ``limit`` lowest report ids."""
    return reports.orderBy("safetyreportid").limit(limit)


def _if_none(reports: DataFrame, matching: DataFrame) -> DataFrame:
    """All reports when ``matching`` has no row, else none.

    The test is a relation of at most one row, so the reports are joined with one row at most; once it turns out empty,
    adaptive execution drops the scan of the reports.
    """
    none = matching.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return reports.join(none, F.lit(True), "left_semi")


def fetch_with_fallback(
    reports: DataFrame, start: str | None = None, end: str | None = None, terms: list[str] | None = None
) -> DataFrame:
    """Matching reports, or every report when nothing matches. The conditions reach the scan of the matching ones."""
    matching = reports.where(in_receive_window(start, end) & term_condition(terms or []))
    return matching.unionByName(_if_none(reports, matching))


def fetch_reports(
    reports: DataFrame,
    start: str | None = None,
    end: str | None = None,
    limit: int = 100,
    terms: list[str] | None = None,
    fallback_limit: int | None = None,
) -> DataFrame:
    """One page of matching reports; when nothing matches, a page of any reports, of ``fallback_limit`` rows if given."""
    matching = reports.where(in_receive_window(start, end) & term_condition(terms or []))
    page = limit if fallback_limit is None else fallback_limit
    return limit_reports(matching, limit).unionByName(limit_reports(_if_none(reports, matching), page))


def balanced_sample(
    reports: DataFrame,
    n_serious: int,
    n_non_serious: int,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Up to the given number of reports per class, reports in the window first, then any date."""
    outside = ~F.coalesce(in_receive_window(start, end), F.lit(False))
    order = {"_outside": outside, "_undated": F.col("receivedate").isNull(), "_date": F.coalesce("receivedate", F.lit(""))}

    def block(serious: bool, n: int) -> DataFrame:
        return first_rows(filter_serious(reports, serious), order, ["safetyreportid"], n)

    return block(True, n_serious).unionByName(block(False, n_non_serious))


def sample_events(events: DataFrame, fraction: float, seed: int = K.SEED) -> DataFrame:
    """Random draw with replacement; the expected size is ``fraction`` times the input."""
    return events.sample(withReplacement=True, fraction=fraction, seed=seed)
