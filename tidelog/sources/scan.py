"""Scans of a log relative to cursors, partition discovery and restore checks.

Cursors and splits are small (one row per partition); the log is big and is joined to them by
partition.  On a written log the seek also prunes: see ``tidelog.sources.logs.read_log_between``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.broadcast import broadcast_bounded
from tidelog.schema import DEFAULT_START_OFFSET


def partition_count(log: DataFrame) -> DataFrame:
    """One row ``n`` = number of partitions of the topic (partitions are ``0 .. n-1``)."""
    return log.agg((F.max("part") + 1).cast("int").alias("n"))


def topic_partitions(log: DataFrame) -> DataFrame:
    """``part`` for every partition ``0 .. n-1`` of the topic, from one aggregate row."""
    return partition_count(log).where(F.col("n") > 0).select(
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"))


def topic_partitions_in_folder(spark, path: str) -> DataFrame:
    """``part`` for every partition ``0 .. n-1`` of a written log, where ``n - 1`` is the highest with a
    message: from the file footers, no rows read."""
    from tidelog.operators.progress import positions_from_footers

    return topic_partitions(positions_from_footers(spark, path).select("part"))


def topic_partitions_of(spark, count: int) -> DataFrame:
    """``part`` for every partition ``0 .. count-1`` of a topic whose partition count is known.  Unlike the
    forms that look at the data, this one has the partitions that never got a message."""
    return spark.range(count).select(F.col("id").cast("int").alias("part"))


def cursors_of(cursors: DataFrame, subscription: str) -> DataFrame:
    """``part, off`` of one subscription's rows of a cursor table ``subscription, part, off``: the largest
    committed offset of each partition.  Cursors of other subscriptions never count."""
    return cursors.where(F.col("subscription") == subscription).groupBy("part").agg(F.max("off").alias("off"))


def cursors_as_of(log: DataFrame, before: str) -> DataFrame:
    """Committed cursor per partition = last offset published before ``before`` (``part, off``)."""
    return (log.where(F.col("publish_time") < F.lit(before).cast("timestamp_ntz"))
            .groupBy("part").agg(F.max("off").alias("off")))


def start_offsets(parts: DataFrame, cursors: DataFrame, part_bound: int | None = None) -> DataFrame:
    """``part, start_off``: the committed cursor of each partition, else offset 0."""
    c = cursors.select("part", F.col("off").alias("_cur"))
    return (parts.join(broadcast_bounded(c, part_bound), "part", "left")
            .select("part", F.coalesce("_cur", F.lit(DEFAULT_START_OFFSET)).cast("bigint").alias("start_off")))


def discover(partitions: DataFrame, known: DataFrame, cursors: DataFrame, subscription: str,
             part_bound: int | None = None) -> DataFrame:
    """New splits: partitions of the topic not yet known, each from its start offset.

    ``known`` lists the partitions already handed out (``part``); nothing is returned when the
    topic did not grow.  Unlike a counter, an anti join never rediscovers a known partition after
    the partition count shrank and grew again.
    """
    new = partitions.join(broadcast_bounded(known.select("part"), part_bound), "part", "left_anti")
    return (start_offsets(new, cursors, part_bound)
            .select(F.lit(subscription).alias("subscription"), "part", "start_off"))


def one_per_partition(ranges: DataFrame) -> DataFrame:
    """The table itself, but reading it fails if a partition is listed twice: a scan that silently joined
    both rows would return messages twice."""
    others = [c for c in ranges.columns if c != "part"]
    one = ranges.groupBy("part").agg(*(F.first(c).alias(c) for c in others), F.count(F.lit(1)).alias("_n"))
    fail = F.raise_error(F.concat(F.lit("one start offset per partition expected; repeated: "), F.col("part")))
    return one.withColumn("_n", F.when(F.col("_n") > 1, fail).otherwise(F.col("_n"))).where("_n = 1").drop("_n")


def scan_from(log: DataFrame, starts: DataFrame, part_bound: int | None = None,
              inclusive: bool = True) -> DataFrame:
    """Rows at or after each partition's start offset (``inclusive=False``: strictly after).

    Partitions without a start row are not read (they have no split); a partition listed twice is an
    error.  ``log`` may be a stream.  The starts have one row per partition and are joined by equality;
    with a partition bound they are broadcast.  On a written log :func:`tidelog.sources.logs.read_log_between`
    reads less."""
    s = one_per_partition(starts.select("part", F.col("start_off").alias("_start")))
    cond = F.col("off") >= F.col("_start") if inclusive else F.col("off") > F.col("_start")
    return log.join(broadcast_bounded(s, part_bound), "part").where(cond).drop("_start")


def scan_between(log: DataFrame, starts: DataFrame, stops: DataFrame,
                 part_bound: int | None = None) -> DataFrame:
    """Rows with ``start_off <= off < stop_off``; a partition without a stop is read to the end."""
    b = (one_per_partition(starts.select("part", F.col("start_off").alias("_start")))
         .join(one_per_partition(stops.select("part", F.col("stop_off").alias("_stop"))), "part", "left"))
    return (log.join(broadcast_bounded(b, part_bound), "part")
            .where((F.col("off") >= F.col("_start")) & (F.col("_stop").isNull() | (F.col("off") < F.col("_stop"))))
            .drop("_start", "_stop"))


def restore_violations(splits: DataFrame, subscription: str, topic: str | None = None) -> DataFrame:
    """Why a set of restored splits cannot be resumed: ``kind, part``.

    ``foreign_subscription``: the split belongs to another subscription.  ``missing_partition``:
    partitions must be ``0 .. n-1`` with ``n`` the number of distinct partitions restored.
    ``topic_mismatch`` (when ``topic`` is given and the splits carry a ``topic`` column): the
    checkpoint was taken on another topic than the live one.
    """
    foreign = (splits.where(F.col("subscription") != F.lit(subscription))
               .select(F.lit("foreign_subscription").alias("kind"), "part"))
    if topic is not None and "topic" in splits.columns:
        foreign = foreign.unionByName(splits.where(F.col("topic") != F.lit(topic))
                                      .select(F.lit("topic_mismatch").alias("kind"), "part"))
    present = splits.select("part").distinct()
    expected = (present.agg(F.count(F.lit(1)).cast("int").alias("n"))
                .where(F.col("n") > 0)
                .select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part")))
    missing = (expected.join(present, "part", "left_anti")
               .select(F.lit("missing_partition").alias("kind"), "part"))
    return foreign.unionByName(missing)


def check_restore(splits: DataFrame, subscription: str, topic: str | None = None) -> None:
    """Strict form: raise on the first violation."""
    bad = restore_violations(splits, subscription, topic).limit(1).collect()
    if bad:
        raise ValueError(f"cannot restore splits: {bad[0]['kind']} at partition {bad[0]['part']}")
