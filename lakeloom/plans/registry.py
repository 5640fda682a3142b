"""Registry of the named queries (Spark callables) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixture_sql import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, fixtures: list[str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle``: the same result as DuckDB SQL over the driver's views; the named
    ``fixtures`` are prepended as CTEs.  None = no SQL form (rows-only check).
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_fixtures(fixtures, oracle) if fixtures else oracle.strip()
        return fn
    return deco


def load_all() -> None:
    from . import (q_catalog, q_checks, q_control, q_loads, q_match,  # noqa: F401
                   q_rows, q_search, q_transitions, q_upsert)
