"""Named queries: key -> (spark, sf_dir) -> DataFrame, plus the oracle SQL.

Every query reads the driver's tables (or data Spark derives from them)
over all rows, so its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn
    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from flowlake.plans import queries_core  # noqa: F401
    from flowlake.plans import queries_ingest  # noqa: F401
    from flowlake.plans import queries_tables  # noqa: F401
