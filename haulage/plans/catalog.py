"""Registry of named queries bound to the driver tables, with SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole tables. The
oracle (when the operation can be written in SQL) is DuckDB-dialect SQL on
the same parquet tables; column names match the Spark result.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from haulage.plans import (q_freight, q_routes, q_entities, q_kpis, q_profile,  # noqa: F401
                               q_sources, q_cleaning, q_ml, q_report, q_sinks)


def queries() -> dict[str, Callable]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
