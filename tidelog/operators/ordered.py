"""Order-dependent helpers that stay parallel when one group holds most of the rows.

A ``Window.partitionBy(part)`` puts a whole partition of a log into one task.  These helpers
split every group into bounded pieces and carry the result across pieces through a small
aggregate:

* :func:`index_within` - 0-based row number inside a group (range-partitioned, so a hot group
  spans many tasks; per-range counts are prefix-summed).  The ranged rows are checkpointed
  once, so the counts and the rows always agree.
* :func:`prefix_max` - running max of a value inside a group, computed per chunk and carried
  across chunks.  ``chunk`` must be monotone in the order (e.g. ``off DIV width``).
* :func:`prefix_sum` - sum over the earlier rows of a group, by chunks of numbered rows.
* :func:`prev_offset` - the previous offset of the same partition (a lag), chunked the same way;
  chunks follow the mean gap of the partition's offsets, so their number follows its rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.broadcast import BROADCAST_ROW_LIMIT, broadcast_bounded
from tidelog.session import checkpoint_root

DEFAULT_CHUNK_WIDTH = 1 << 16


def index_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                 out: str = "idx", num_ranges: int | None = None,
                 group_bound: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside its group, in ``order_cols`` order.

    Ties in ``order_cols`` get distinct, arbitrary positions; null groups and null order values are
    numbered like any other (nulls first).  ``group_bound`` is an upper bound on the number of
    groups, if known; it bounds the per-range table (groups + ranges rows) so it is broadcast.
    Without it the table is measured with a capped count and broadcast only under the limit.
    """
    spark = df.sparkSession
    n = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(group_cols) + list(order_cols)
    # Range ids and row ids are fixed once and written to the shared checkpoint folder: two
    # evaluations of a range exchange may sample different bounds, and the per-range counts
    # below must describe exactly the rows they are joined back to.
    checkpoint_root(spark)
    ranged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_rid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    w = Window.partitionBy(*group_cols).orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    stats = (ranged.groupBy(*group_cols, "_rid")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
             .drop("_n"))
    # (group, range) pairs: every range covers a contiguous run of groups, so with a bound on the
    # groups the table is bounded; without one its size is measured (capped count) before deciding
    if group_bound is not None:
        bound = group_bound + n
    else:
        bound = stats.limit(BROADCAST_ROW_LIMIT + 1).count()
    stats = stats.select(*[F.col(g).alias(f"_s_{g}") for g in group_cols], F.col("_rid").alias("_s_rid"),
                         "_first", "_before")
    stats = broadcast_bounded(stats, bound)
    # null-safe keys: a null group is a group like any other and keeps its rows
    cond = [ranged[g].eqNullSafe(stats[f"_s_{g}"]) for g in group_cols] + [ranged["_rid"] == stats["_s_rid"]]
    joined = ranged.join(stats, cond).drop(*[f"_s_{g}" for g in group_cols], "_s_rid")
    return (joined.withColumn(out, (F.col("_before") + F.col("_mid") - F.col("_first")).cast("bigint"))
            .drop("_rid", "_mid", "_first", "_before"))


def prefix_max(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str,
               chunk: Column, out: str, inclusive: bool = True) -> DataFrame:
    """Running max of ``value`` inside ``keys`` in ``order_cols`` order.

    ``inclusive=False`` gives the max over strictly earlier rows (null for the first row).
    """
    w_in = Window.partitionBy(*keys, "_chunk").orderBy(*order_cols)
    local = (df.withColumn("_chunk", chunk)
             .withColumn("_incl", F.max(value).over(w_in.rowsBetween(Window.unboundedPreceding, 0))))
    if not inclusive:
        local = local.withColumn("_local", F.max(value).over(w_in.rowsBetween(Window.unboundedPreceding, -1)))
    else:
        local = local.withColumn("_local", F.col("_incl"))
    # The carry table is built from the windowed rows: it reuses their (keys, chunk) exchange, so
    # the input is read once and the per-chunk aggregate needs no shuffle of its own.
    w_c = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (local.groupBy(*keys, "_chunk").agg(F.max("_incl").alias("_cmax"))
             .withColumn("_carry", F.max("_cmax").over(w_c))
             .select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_chunk").alias("_c_chunk"), "_carry"))
    # null-safe keys: no not-null filter is inferred on the carry side, so both sides keep the
    # same exchange below them and it is shuffled once
    cond = [local[k].eqNullSafe(carry[f"_c_{k}"]) for k in keys] + [local["_chunk"].eqNullSafe(carry["_c_chunk"])]
    res = local.join(carry, cond, "left").drop(*[f"_c_{k}" for k in keys], "_c_chunk")
    return res.withColumn(out, F.greatest("_local", "_carry")).drop("_chunk", "_local", "_carry", "_incl")


def prefix_sum(df: DataFrame, keys: Sequence[str], index: str, value: str, out: str,
               width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """``out`` = sum of ``value`` over the earlier rows of the same ``keys`` (0 for the first).

    ``index`` numbers the rows of a group without gaps (:func:`index_within`); a chunk is ``width`` of them, so a hot
    group is many chunks of equal size, carried through one row per chunk."""
    earlier = Window.partitionBy(*keys, "_chunk").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    local = (df.withColumn("_chunk", F.expr(f"`{index}` div {int(width)}"))
             .withColumn("_local", F.coalesce(F.sum(value).over(earlier), F.lit(0))))
    chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (local.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_sum"))
             .select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_chunk").alias("_c_chunk"),
                     F.coalesce(F.sum("_sum").over(chunks), F.lit(0)).alias("_carry")))
    cond = [local[k].eqNullSafe(carry[f"_c_{k}"]) for k in keys] + [local["_chunk"].eqNullSafe(carry["_c_chunk"])]
    return (local.join(carry, cond).withColumn(out, (F.col("_local") + F.col("_carry")).cast("bigint"))
            .drop(*[f"_c_{k}" for k in keys], "_c_chunk", "_chunk", "_local", "_carry"))


def prev_offset(log: DataFrame, out: str = "prev_off", width: int = DEFAULT_CHUNK_WIDTH,
                part: str = "part", off: str = "off") -> DataFrame:
    """``out`` = previous ``off`` of the same ``part`` (null for the first), without one task per part.

    A chunk is ``width`` offsets wide times the partition's mean gap between offsets, so a partition of
    ``n`` rows has about ``n / width`` chunks however sparse its offsets are."""
    span = log.groupBy(F.col(part).alias("_p")).agg(
        F.min(off).alias("_lo"), F.greatest(F.lit(1), F.ceil((F.max(off).cast("double") - F.min(off) + 1) / F.count(off))).cast("bigint").alias("_gap"))
    placed = log.join(span, log[part].eqNullSafe(span["_p"])).drop("_p")
    chunk = F.expr(f"(`{off}` - _lo) div (_gap * {int(width)})")
    return prefix_max(placed, [part], [off], off, chunk, out, inclusive=False).drop("_lo", "_gap")
