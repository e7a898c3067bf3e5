"""Routing of outgoing records to log partitions.

Integer keys: ``pmod(key, n)``.  String keys: the first 32 bits of the key's MD5 as an
unsigned integer, modulo ``n``.  No key: round-robin by the record's rank.

``n`` is a number, or a column where the count changes while records are written (:func:`partitions_at`).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_int(key: Column, n: int | Column) -> Column:
    return F.pmod(key.cast("bigint"), F.lit(n)).cast("int")


def route_str(key: Column, n: int | Column) -> Column:
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n)).cast("int")


def route_round_robin(rank: Column, n: int | Column) -> Column:
    return F.pmod(rank.cast("bigint"), F.lit(n)).cast("int")


def partitions_at(at_ms: Column, history: Sequence[tuple[int, int]]) -> Column:
    """Partition count in force at ``at_ms``, as of a history of ``(from_ms, count)``.

    The history has one entry per change of the topic, so it is a pair of literal arrays and no record is shuffled.
    A record before the first entry, or without a time, is under the first count."""
    changes = sorted((int(t), int(n)) for t, n in history)
    if not changes or any(n < 1 for _, n in changes) or len({t for t, _ in changes}) < len(changes):
        raise ValueError("a partition history has at least one entry, counts from one on and one count per time")
    since = F.lit([t for t, _ in changes]).cast("array<bigint>")
    known = F.size(F.filter(since, lambda t: t <= at_ms))
    return F.element_at(F.lit([n for _, n in changes]).cast("array<int>"), F.greatest(known, F.lit(1)))
