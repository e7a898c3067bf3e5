"""Streaming sink into a log folder.

Every micro-batch is encoded (:func:`tidelog.operators.sink.encode_for`), given offsets that continue
each partition after the batches before it, and written to ``path/batch=<id>/part=K/``; its heads
(next offset per partition) go to ``path/_heads/batch=<id>/``.  A replayed batch overwrites both, so
the log holds every record exactly once.  Heads are read from the small ``_heads`` table, never by
scanning the log; ``_``-prefixed folders are invisible to log readers.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.routing import partitions_at
from tidelog.operators import sink as snk
from tidelog.operators.broadcast import broadcast_bounded
from tidelog.operators.progress import positions_from_footers
from tidelog.schema import LOG_SCHEMA
from tidelog.sources.paths import partition_history, read_if_there


def _heads_before(spark, path: str, batch_id: int) -> DataFrame | None:
    """Next offset per partition after the batches before ``batch_id``: every batch writes the heads of
    all partitions so far, so only the batch before is read."""
    h = read_if_there(spark, os.path.join(path, "_heads", f"batch={batch_id - 1}")) if batch_id else None
    return None if h is None else h.select("part", F.col("head").alias("_head"))


def _watermark_before(spark, path: str, batch_id: int) -> int | None:
    """Largest record time (ms) of the batches before, one value; every batch writes it anew."""
    w = read_if_there(spark, os.path.join(path, "_watermark", f"batch={batch_id - 1}")) if batch_id else None
    return None if w is None else w.first()["watermark"]


def log_sink_writer(path: str, options, order_cols: Sequence[str | Column], key: Column | None = None,
                    key_kind: str = "int", ts_ms: Column | None = None, publish_ms: int | None = None,
                    rank_order: Sequence[str] | None = None, history: str | None = None, at_ms: Column | None = None):
    """The ``foreachBatch`` function of the log sink: ``write(batch, batch_id)``.

    A record without a time of its own (``ts_ms`` null) gets the watermark - the largest record time of the
    batches before - and the wall clock only before any record time was seen.  Without ``key`` records
    are dealt round robin in ``rank_order``, each batch from the partition after the last one on: as offsets
    have no gaps, the heads add up to the number of records before.

    With ``history``, the folder of a table ``from_ms, count``, the sink follows the topic's partition count: the
    table is read anew in every batch, and each record is routed under the count in force at ``at_ms`` (default: the publish
    time).  ``options.num_partitions`` then has no effect."""
    import time

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = publish_ms if publish_ms is not None else int(time.time() * 1000)
        watermark = _watermark_before(spark, path, batch_id)
        rank = counts = None
        most = options.num_partitions
        if history is not None:
            changes = partition_history(spark, history)
            most = max(n for _, n in changes)
            counts = partitions_at(at_ms if at_ms is not None else F.lit(now).cast("bigint"), changes)
        seen = Observation()
        records = batch if ts_ms is None else batch.observe(seen, F.max(ts_ms).alias("watermark"))
        heads = _heads_before(spark, path, batch_id)
        if key is None:
            # one row, the sum over one row per partition
            sent = 0 if heads is None else heads.agg(F.sum("_head")).first()[0] or 0
            records, rank = snk.round_robin_rank(records, list(rank_order or ())), F.col("_rank") + F.lit(sent)
        env = snk.encode_for(records, options, ts_ms=ts_ms, watermark_ms=None if watermark is None else F.lit(watermark).cast("bigint"),
                             now_ms=now, key=key, key_kind=key_kind, rank=rank, num_partitions=counts)
        numbered = snk.publish(env, order_cols, now, num_partitions=most)
        if heads is not None:
            numbered = (numbered.join(broadcast_bounded(heads, most), "part", "left")
                        .withColumn("off", F.col("off") + F.coalesce("_head", F.lit(0)))
                        .drop("_head"))
        numbered = numbered.select([f.name for f in LOG_SCHEMA.fields])
        out = os.path.join(path, f"batch={batch_id}")
        (numbered.repartitionByRange("part", "off").sortWithinPartitions("part", "off")
         .write.mode("overwrite").partitionBy("part").parquet(out))
        # heads of this batch from the footers of the files just written (no rows read)
        now = positions_from_footers(spark, out).select("part", (F.col("position") + 1).alias("head"))
        if heads is not None:
            now = (now.unionByName(heads.select("part", F.col("_head").alias("head")))
                   .groupBy("part").agg(F.max("head").alias("head")))
        now.write.mode("overwrite").parquet(os.path.join(path, "_heads", f"batch={batch_id}"))
        if ts_ms is not None:
            # the largest time came along with the rows: the batch is not read again for it
            times = [t for t in (seen.get["watermark"], watermark) if t is not None]
            (spark.createDataFrame([(max(times, default=None),)], "watermark BIGINT")
             .write.mode("overwrite").parquet(os.path.join(path, "_watermark", f"batch={batch_id}")))

    return write


def start_log_sink(stream: DataFrame, path: str, options, checkpoint: str, order_cols: Sequence[str | Column],
                   key: Column | None = None, key_kind: str = "int", ts_ms: Column | None = None,
                   publish_ms: int | None = None, trigger_available_now: bool = True,
                   rank_order: Sequence[str] | None = None, history: str | None = None,
                   at_ms: Column | None = None) -> StreamingQuery:
    """Publish a stream of records to the log folder ``path`` under ``options`` (:class:`LogSinkOptions`).

    ``order_cols`` (names or expressions over the envelope) give the order of offsets inside a
    partition within one batch; batches follow each other."""
    write = log_sink_writer(path, options, order_cols, key, key_kind, ts_ms, publish_ms, rank_order, history, at_ms)
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()
