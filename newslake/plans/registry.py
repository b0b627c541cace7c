"""Registry of named queries: ``name -> (callable(spark, sf_dir), oracle SQL or None)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    """Register ``fn`` under ``name`` with its oracle SQL (``None``: no SQL form)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name!r}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def all_queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def all_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
