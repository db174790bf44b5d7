"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import as_column


def ascii_only(c: Column | str) -> Column:
    """Drop characters outside ASCII, then collapse and trim white space."""
    plain = F.regexp_replace(as_column(c), r"[^\x00-\x7F]+", "")
    return F.trim(F.regexp_replace(plain, r"[\t\n\x0B\f\r\x1C-\x1F ]+", " "))
