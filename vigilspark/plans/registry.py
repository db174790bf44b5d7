"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a function from ``Tables`` to DataFrame under a name."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, oracle)
        return build

    return register
