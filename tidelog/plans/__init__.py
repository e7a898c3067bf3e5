"""Registered queries over the driver's test tables, each paired with its DuckDB SQL."""

from tidelog.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "queries", "oracle_sql"]
