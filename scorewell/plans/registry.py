"""Registry of driver queries and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables; its
oracle is SQL over the same tables (registered as views by the checker).
Every computed column is aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
_CACHE: dict[tuple, object] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def memo(spark: SparkSession, sf_dir: str, key: str, build: Callable[[], object]):
    """Reuse a fitted model across queries of one session and data folder."""
    k = (spark.sparkContext.applicationId, sf_dir, key)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]
