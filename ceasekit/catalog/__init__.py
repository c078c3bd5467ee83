"""Registry of named queries over the derived study tables.

Each entry is ``name -> (fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
``__spark_entry__`` exposes them to the driver; ``oracle_sql`` holds the DuckDB side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ceasekit.oracle_sql import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with its DuckDB oracle (CTEs added)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def oracle(name: str) -> str:
    """The DuckDB SQL of ``name`` with the CTEs it needs (resolved after all loads)."""
    return with_ctes(SQL[name])


def load_all() -> None:
    from ceasekit.catalog import base, features, model, observation, profiles, quality, sources  # noqa: F401
    base.register_aliases()
