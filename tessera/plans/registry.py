"""Registry of named queries and their DuckDB oracle SQL.

``register("id", sql)`` records a callable ``(spark, sf_dir) -> DataFrame``
under a SURVEY §2 id.  ``sql`` is DuckDB SQL over the raw test tables that
must give the same rows (same column names, same types) as the Spark side;
``None`` marks a query without an SQL twin (checked by rows / pytest).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query id {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules runs their ``register`` decorators.
    from tessera.plans import (  # noqa: F401
        q_analyses, q_io, q_layout, q_relational, q_streaming,
    )


def queries() -> dict[str, Query]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
