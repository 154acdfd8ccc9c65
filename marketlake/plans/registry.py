"""Query registry: name -> callable(spark, sf_dir) -> DataFrame, plus the
DuckDB twin of each query that has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(fn: QueryFn | None = None, *, sql: str | None = None):
    """Register ``fn`` under its name; ``sql`` is its DuckDB twin (omit for
    operators whose result SQL cannot express, e.g. iterative fits)."""
    def deco(f: QueryFn) -> QueryFn:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql.strip()
        return f
    return deco(fn) if fn is not None else deco


def all_queries() -> dict[str, QueryFn]:
    # importing the modules fills QUERIES / ORACLE
    from . import (q_sources, q_filters, q_joins, q_aggs, q_windows, q_upserts,  # noqa: F401
                   q_scalars, q_reshape, q_tree, q_features, q_model, q_payloads, q_landed, q_stored)
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
