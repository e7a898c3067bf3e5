"""Redelivery filter of a stream whose batches come in any order.

A restart reads again what was consumed after the last commit, and files of one partition may be read in
any order.  Of every partition the offsets already passed on are kept as disjoint ranges; a row inside one
is a redelivery and is dropped, every other row is new, wherever it lies.  Nothing depends on time or on
other partitions.

Ranges are kept by chunks of ``CHUNK`` offsets and never cross one: a batch only reads and writes the chunks
that it touches, a chunk's rows fit a task, and a partition that holds most of the log spreads over its
chunks.  The rows of a batch are shuffled once, by (part, chunk).  State has one row for each chunk and
gap; chunks that changed go to a delta, see :mod:`tidelog.streaming.store`.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.streaming.store import EVERY, BatchStore

CHUNK = 1 << 16


def _chunk_of(width: int):
    return F.expr(f"off DIV {int(width)}")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """``part, chunk, lo, hi``: the union of ranges of whole offsets as maximal disjoint ranges; ranges that
    touch become one.  Each must lie in one chunk."""
    order = Window.partitionBy("part", "chunk").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0)).over(order)
    return (ranges.withColumn("_island", island).groupBy("part", "chunk", "_island")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island"))


def ranges_of(rows: DataFrame, width: int = CHUNK) -> DataFrame:
    """``part, chunk, lo, hi``: the runs of consecutive offsets of ``rows`` (``part, off``), cut at chunks."""
    chunked = rows.select("part", _chunk_of(width).alias("chunk"), "off").distinct()
    run = F.col("off") - F.row_number().over(Window.partitionBy("part", "chunk").orderBy("off"))
    return (chunked.withColumn("_run", run).groupBy("part", "chunk", "_run")
            .agg(F.min("off").alias("lo"), F.max("off").alias("hi")).drop("_run"))


def outside(rows: DataFrame, ranges: DataFrame, width: int = CHUNK) -> DataFrame:
    """The rows of ``rows`` whose offset lies in no range of its partition."""
    chunk = _chunk_of(width)
    r = ranges.select(F.col("part").alias("_part"), F.col("chunk").alias("_of"), "lo", "hi")
    at = (F.col("part") == F.col("_part")) & (F.col("_chunk") == F.col("_of")) & F.col("off").between(F.col("lo"), F.col("hi"))
    return rows.withColumn("_chunk", chunk).join(r, at, "left_anti").drop("_chunk")


def range_filter(out_dir: str, state_dir: str, width: int = CHUNK, every: int = EVERY):
    """The ``foreachBatch`` function: first deliveries to ``out/batch=<id>``, ranges to ``state``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = BatchStore(spark, state_dir, ["part", "chunk"], every)
        passed = store.read(before=batch_id)
        chunk = _chunk_of(width)
        # one shuffle: the duplicates inside the batch and the join with the ranges are dealt alike
        fresh = batch.withColumn("_chunk", chunk).repartition("part", "_chunk").dropDuplicates(["part", "_chunk", "off"]).drop("_chunk")
        if passed is not None:
            fresh = outside(fresh, passed, width)
        out = os.path.join(out_dir, f"batch={batch_id}")
        fresh.write.mode("overwrite").parquet(out)
        new = ranges_of(spark.read.schema(batch.schema).parquet(out).select("part", "off"), width)
        if passed is not None:
            touched = passed.join(new.select("part", "chunk").distinct(), ["part", "chunk"], "left_semi")
            # dealt anew by another expression: a union of two sides dealt by (part, chunk) passes for dealt by
            # them, although an adaptive join may still undo that in one of them
            both = new.unionByName(touched.select("part", "chunk", "lo", "hi")).repartition(F.xxhash64("part", "chunk"))
            new = merged_ranges(both)
        store.write(new, batch_id)

    return write


def start_redelivery_filter(stream: DataFrame, out_dir: str, state_dir: str, checkpoint: str,
                            width: int = CHUNK, every: int = EVERY) -> StreamingQuery:
    """Writes every message of ``stream`` (``part, off`` and more) to ``out_dir`` once."""
    return (stream.writeStream.foreachBatch(range_filter(out_dir, state_dir, width, every))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
