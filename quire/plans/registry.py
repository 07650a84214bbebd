"""Registry of checked queries: one Spark plan per operator and, where the
operator is expressible in SQL, the equivalent DuckDB query (the oracle).

Every query reads the given tables (or views derived from them), runs over
whole tables and returns scalar columns: dates as ``YYYY-MM-DD`` text, lists
joined into text, doubles rounded the same way on both sides, and every
computed column aliased identically in both engines.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if any) to the registry."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import apply_confs
            apply_confs(spark)           # session settings + package on the executors
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import checked_search, checked_dedup, checked_trends, checked_digest, checked_json  # noqa: F401
    from . import checked_sources, checked_fill, checked_infer, checked_daily, checked_view  # noqa: F401
