"""Query registry: key -> (Spark builder, DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from estrella.session import sized_session
from estrella.sources.tables import stored_bytes

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query builder under ``key``, with its oracle SQL when one exists. The registered
    query runs in a session whose tasks are sized by the input; ``fn`` is returned as it is."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")

        @wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(sized_session(spark, stored_bytes(spark, sf_dir)), sf_dir)

        QUERIES[key] = query
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn

    return deco
