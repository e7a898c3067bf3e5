"""Name -> (Spark query, DuckDB SQL or None).

A query is ``fn(spark, sf_dir) -> DataFrame``.  The SQL runs on DuckDB views of the same
parquet tables and must give the same rows and column names.  ``None`` marks a query whose
result is checked by row count only (and by a brute-force test in ``tests/``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load() -> None:
    # importing the modules fills REGISTRY
    from tidelog.plans import assignment_queries, log_queries, message_queries, sink_queries, stream_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
