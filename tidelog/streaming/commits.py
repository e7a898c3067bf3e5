"""The checkpoint commit rule applied to a stream of completion notifications.

Each micro-batch of notifications (``reader, ck, notified_at``) is judged against the checkpoint
table (``reader, ck, added_at, seq``, re-read every batch since it grows) and the state carried
from earlier batches: the highest sequence completed so far per reader.  Results go to
``out/batch=<id>`` and the new state to ``state/batch=<id>``; both are overwritten if the batch is
replayed, and the state read for batch ``b`` only uses batches before ``b``.  The state has one row
per reader; nothing else is kept between batches.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.progress import effective_commits
from tidelog.sources.paths import read_if_there


def _state_before(spark: SparkSession, state_dir: str, batch_id: int) -> DataFrame | None:
    """``reader, max_seq`` after the batches before: every batch writes the state of all readers."""
    return read_if_there(spark, os.path.join(state_dir, f"batch={batch_id - 1}")) if batch_id else None


def commit_tracker(checkpoints_path: str, out_dir: str, state_dir: str):
    """The ``foreachBatch`` function applying the commit rule incrementally."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cks = spark.read.parquet(checkpoints_path)
        prior = _state_before(spark, state_dir, batch_id)
        res = effective_commits(cks, batch, prior=prior)
        res.select("reader", "ck", "notified_at", "effective").write.mode("overwrite").parquet(
            os.path.join(out_dir, f"batch={batch_id}"))
        new = res.where(F.col("seq").isNotNull()).groupBy("reader").agg(F.max("seq").alias("max_seq"))
        if prior is not None:
            new = new.unionByName(prior).groupBy("reader").agg(F.max("max_seq").alias("max_seq"))
        new.write.mode("overwrite").parquet(os.path.join(state_dir, f"batch={batch_id}"))

    return write


def start_commit_tracker(notifications: DataFrame, checkpoints_path: str, out_dir: str, state_dir: str,
                         checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = (notifications.writeStream.foreachBatch(commit_tracker(checkpoints_path, out_dir, state_dir))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
