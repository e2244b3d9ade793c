"""Registered queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}

MODULES = ("sources", "filters", "texts", "labels", "metrics", "samples", "evaluation", "jobs")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its row count is checked."""
    def register(run: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Entry(run, sql)
        return run

    return register


def load() -> dict[str, Entry]:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
    return CATALOG
