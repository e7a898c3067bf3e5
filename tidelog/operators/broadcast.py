"""Broadcast only behind a size bound.

A side is hinted for broadcast when the caller can prove an upper bound on its rows (a
partition count, a task count, one row per range) and that bound is under the limit.  Beyond it
the plain DataFrame is returned and the planner shuffles; with AQE on it can still switch to a
broadcast after it has measured the materialized side (``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROW_LIMIT = 2_000_000


def broadcast_bounded(df: DataFrame, row_bound: int | None, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    if row_bound is not None and 0 <= row_bound <= limit:
        return F.broadcast(df)
    return df
