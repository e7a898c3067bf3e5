"""Structured Streaming over logs.

A log stream is a file-source stream (``readStream.parquet``) shaped into the envelope; per
trigger the source lists new files, so new partitions and new data are picked up as they land.
Every run here uses ``trigger(availableNow=True)``: process what is there, then stop; a restart
with the same checkpoint folder continues after the last committed batch (exactly once into the
file sink).

Cursor commits: :func:`start_with_cursors` writes each micro-batch's rows first and the cursors of its
subscription (max offset per partition, skipped messages included) second, both keyed by batch id so a
replay of the same batch overwrites instead of adding.
"""

from __future__ import annotations

import os
from typing import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.options import FlowControl
from tidelog.schema import LOG_SCHEMA, MESSAGE_SCHEMA
from tidelog.streaming.store import EVERY, BatchStore


def table_stream(spark: SparkSession, sf_dir: str, name: str, flow: FlowControl | None = None) -> DataFrame:
    """A stream over one of the test tables (a single parquet file; a glob makes it a source)."""
    schema = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
    r = spark.readStream.schema(schema)
    if flow is not None:
        r = r.option("maxBytesPerTrigger", str(flow.bytes_outstanding))
    return r.parquet(os.path.join(sf_dir, f"{name[:-1]}[{name[-1]}].parquet"))


def log_stream(spark: SparkSession, path: str, flow: FlowControl | None = None) -> DataFrame:
    """A stream over a log folder ``path/part=K/*.parquet``; ``flow`` caps input per trigger."""
    r = spark.readStream.schema(LOG_SCHEMA).option("basePath", path)
    if flow is not None:
        r = r.option("maxBytesPerTrigger", str(flow.bytes_outstanding))
    return r.parquet(path).select([f.name for f in LOG_SCHEMA.fields])


def message_stream(spark: SparkSession, path: str, flow: FlowControl | None = None) -> DataFrame:
    """A stream over a message log (:mod:`tidelog.operators.messages`): bytes, key and attributes as written."""
    r = spark.readStream.schema(MESSAGE_SCHEMA).option("basePath", path)
    if flow is not None:
        r = r.option("maxBytesPerTrigger", str(flow.bytes_outstanding))
    return r.parquet(path).select([f.name for f in MESSAGE_SCHEMA.fields])


def to_event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need ``TIMESTAMP``; the log's wall-clock ``TIMESTAMP_NTZ`` is UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def run_to_files(df: DataFrame, out: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Append the stream to parquet files until the input is drained (exactly once)."""
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(out)
    q.awaitTermination()
    _raise(q)


def run_complete(df: DataFrame, out: str, checkpoint: str) -> None:
    """Complete-mode aggregate: every micro-batch overwrites ``out`` with the full result."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (df.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    _raise(q)


def start_with_cursors(records: DataFrame, data_dir: str, cursor_dir: str, checkpoint: str,
                       emit: Callable[[DataFrame], DataFrame] | None = None, subscription: str = "",
                       every: int = EVERY) -> StreamingQuery:
    """Write each batch's emitted rows, then the cursors of ``subscription``; both idempotent per batch id.

    ``cursor_dir`` is a store of ``subscription, part, position`` (:mod:`tidelog.streaming.store`), kept apart
    for each subscription: a batch writes the partitions it read, at their highest offset so far."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = emit(batch) if emit is not None else batch
        out.write.mode("overwrite").parquet(os.path.join(data_dir, f"batch={batch_id}"))
        store = cursor_store(batch.sparkSession, cursor_dir, subscription, every)
        now = batch.groupBy("part").agg(F.max("off").alias("position"))
        before = store.read(before=batch_id)
        if before is not None:
            now = now.join(before.select("part", F.col("position").alias("_before")), "part", "left").select(
                "part", F.greatest("position", "_before").alias("position"))
        store.write(now.select(F.lit(subscription).alias("subscription"), "part", "position"), batch_id)

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def cursor_store(spark: SparkSession, cursor_dir: str, subscription: str = "", every: int = EVERY) -> BatchStore:
    """The cursors of one subscription, in a folder of its own."""
    return BatchStore(spark, os.path.join(cursor_dir, "subscription=" + quote(subscription, safe="")), ["subscription", "part"], every)


def committed_cursors(spark: SparkSession, cursor_dir: str, subscription: str = "") -> DataFrame:
    """``part, position`` of a subscription after every committed batch."""
    rows = cursor_store(spark, cursor_dir, subscription).read()
    if rows is None:
        return spark.createDataFrame([], "part INT, position BIGINT")
    return rows.select("part", "position")


def _raise(q: StreamingQuery) -> None:
    e = q.exception()
    if e is not None:
        raise RuntimeError(f"streaming query failed: {e}")


def open_log_stream(spark: SparkSession, path: str, options, cursors: DataFrame | str | None = None,
                    part_bound: int | None = None) -> DataFrame:
    """Records stream of the log folder ``path`` under ``options`` (:class:`LogSourceOptions`):
    flow control per trigger, decoder, timestamp, error policy.

    With ``cursors`` every partition resumes from its committed cursor (``options.resume``), else from
    offset 0.  Cursors are the folder that :func:`start_with_cursors` writes, or a table of ``part, position``;
    of a table with a ``subscription`` column only the rows of ``options.subscription`` count.  A partition
    listed twice fails the stream."""
    from tidelog.operators.broadcast import broadcast_bounded
    from tidelog.operators.records import records_for
    from tidelog.sources.scan import one_per_partition

    log = log_stream(spark, path, options.flow_control)
    if isinstance(cursors, str):
        cursors = committed_cursors(spark, cursors, options.subscription)
    if cursors is not None:
        if "subscription" in cursors.columns:
            cursors = cursors.where(F.col("subscription") == options.subscription)
        starts = broadcast_bounded(one_per_partition(cursors.select("part", F.col("position").alias("_start"))), part_bound)
        after = (F.col("off") >= F.col("_start")) if options.resume == "inclusive" else (F.col("off") > F.col("_start"))
        log = log.join(starts, "part", "left").where(F.col("_start").isNull() | after).drop("_start")
    return records_for(log, options)
