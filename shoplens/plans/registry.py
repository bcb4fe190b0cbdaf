"""

Query modules register themselves with ``@register(name, oracle_sql)``;
``queries()`` / ``oracle_sql()`` import them all on first use. Every
query reads the driver tables (or views Spark derives from them) in full.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("report_queries", "ops_queries", "fn_queries", "stream_queries")


def register(name: str, oracle: str | None = None):
    """Decorator: add a ``(spark, sf_dir) -> DataFrame`` query and its oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"shoplens.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
