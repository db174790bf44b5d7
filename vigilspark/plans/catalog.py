"""All registered queries."""

from __future__ import annotations

from . import profile_queries, report_queries, stream_queries  # noqa: F401  (registration)
from .registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)
