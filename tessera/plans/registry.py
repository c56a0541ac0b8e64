"""Registry of named queries: each entry is a Spark callable ``(spark,
sf_dir) -> DataFrame`` and, where the result is expressible in SQL, the
DuckDB oracle text over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tessera.plans import queries_core, queries_aggs, queries_stats, queries_text, queries_features, queries_models  # noqa: F401
