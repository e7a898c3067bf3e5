"""Split ids and split / assignment state as JSON text (lossless, versioned)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schema import SPLIT_ID_FORMAT, STATE_VERSION

SPLIT_STATE_DDL = "v INT, subscription STRING, part INT, start_off BIGINT"
ENUMERATOR_STATE_DDL = ("v INT, discovery STRUCT<subscription: STRING, topic: STRING>, "
                        "task INT, split STRUCT<subscription: STRING, part: INT, start_off: BIGINT>")


def split_id(part: Column | str = "part", start_off: Column | str = "start_off",
             subscription: Column | str = "subscription") -> Column:
    """``"<part>-<start offset>-<subscription>"``."""
    return F.format_string(SPLIT_ID_FORMAT, F.col(part) if isinstance(part, str) else part,
                           F.col(start_off) if isinstance(start_off, str) else start_off,
                           F.col(subscription) if isinstance(subscription, str) else subscription)


def split_to_state(df: DataFrame, out: str = "state") -> DataFrame:
    """Serialize each split row to a versioned JSON document."""
    return df.withColumn(out, F.to_json(F.struct(F.lit(STATE_VERSION).alias("v"), "subscription",
                                                 "part", "start_off")))


def split_from_state(df: DataFrame, state: str = "state") -> DataFrame:
    """Parse split state written by :func:`split_to_state`; an unknown version fails the query."""
    s = F.from_json(F.col(state), SPLIT_STATE_DDL)
    parsed = df.withColumn("_s", s)
    checked = F.when(F.col("_s.v") == STATE_VERSION, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("unknown split state version: "), F.col(state))))
    return (parsed.where(checked)
            .select(F.col("_s.subscription").alias("subscription"), F.col("_s.part").alias("part"),
                    F.col("_s.start_off").alias("start_off")))


def dedup_splits(splits: DataFrame) -> DataFrame:
    """A split added twice (same split id) counts once.  Two start offsets of one partition are
    two ids, so both stay; resolve those with :func:`tidelog.operators.assign.upsert_splits`."""
    return (splits.withColumn("split_id", split_id())
            .dropDuplicates(["split_id"]))


def enumerator_to_state(assignments: DataFrame, subscription: str, topic: str, out: str = "state") -> DataFrame:
    """Enumerator checkpoint as rows: one versioned JSON document per split with the discovery
    header (subscription, topic) and the split's task, absent when unassigned.  Row-wise, so the
    state of a large topic never has to fit in one record."""
    doc = F.struct(F.lit(STATE_VERSION).alias("v"),
                   F.struct(F.lit(subscription).alias("subscription"), F.lit(topic).alias("topic")).alias("discovery"),
                   F.col("task").cast("int").alias("task"),
                   F.struct("subscription", "part", "start_off").alias("split"))
    return assignments.select(F.to_json(doc).alias(out))


def enumerator_from_state(df: DataFrame, state: str = "state") -> DataFrame:
    """``subscription, topic, part, start_off, task`` from :func:`enumerator_to_state` rows."""
    s = df.select(F.from_json(F.col(state), ENUMERATOR_STATE_DDL).alias("_s"), F.col(state))
    checked = F.when(F.col("_s.v") == STATE_VERSION, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("unknown enumerator state version: "), F.col(state))))
    return (s.where(checked)
            .select(F.col("_s.split.subscription").alias("subscription"), F.col("_s.discovery.topic").alias("topic"),
                    F.col("_s.split.part").alias("part"), F.col("_s.split.start_off").alias("start_off"),
                    F.col("_s.task").alias("task")))
