"""Registry of named queries: a Spark callable each, and SQL text where SQL can say the same."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

MODULES = ["tables", "cleaning", "profiles", "features", "evaluation", "selection", "modeling"]


def register(name: str, sql: str | None = None):
    """Decorator that registers a query under ``name`` with its SQL counterpart."""

    def keep(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} registered twice")
        _queries[name] = fn
        if sql is not None:
            _sql[name] = sql
        return fn

    return keep


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"proclivity.catalog.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
