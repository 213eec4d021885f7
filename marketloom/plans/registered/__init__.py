"""Queries over the driver's tables, one module per topic.

Each module fills a ``QuerySet``: a name, the Spark query and, where SQL can
say the same, an independent SQL text that is used as the oracle.
"""

from __future__ import annotations

from importlib import import_module

from .base import Query

TOPICS = ("market", "warehouse", "text", "stats", "forecast", "models", "kpi")


def _sets():
    return [import_module(f"{__name__}.{topic}").SET for topic in TOPICS]


def all_queries() -> dict[str, Query]:
    return {name: query for s in _sets() for name, query in s.queries.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for s in _sets() for name, sql in s.oracles.items()}
