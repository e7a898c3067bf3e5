"""Logs built from the driver's test tables (their stand-in input).

These only shape rows into the log envelope; every query then runs through the library's
operators and must hold on any data of this schema.

* events log:   part = user_id % 8, off = event_id, publish_time = ts,
                event_time = null when event_id % 5 = 0 else ts - 90 s,
                data = 'bad:' || props when event_id % 10 = 7 else props, attr = event_type.
* lineitem log: part = l_orderkey % 16, off = row number inside the part ordered by
                (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate),
                publish_time = l_shipdate, no event time, data = {"k": <quantity>},
                attr = l_returnflag || l_linestatus, value = l_extendedprice.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.ordered import index_within
from tidelog.schema import LOG_SCHEMA

EVENTS_PARTITIONS = 8
LINEITEM_PARTITIONS = 16
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log_from(table(spark, sf_dir, "events"))


def events_log_from(ev: DataFrame) -> DataFrame:
    """The events log over any ``events``-shaped DataFrame, batch or streaming."""
    return ev.select(
        (F.col("user_id") % EVENTS_PARTITIONS).cast("int").alias("part"),
        F.col("event_id").alias("off"),
        F.col("ts").alias("publish_time"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("ts") - F.expr("INTERVAL 90 SECONDS")).alias("event_time"),
        F.when(F.col("event_id") % 10 == 7, F.concat(F.lit("bad:"), F.col("props")))
         .otherwise(F.col("props")).alias("data"),
        F.col("event_type").alias("attr"),
        F.col("value"),
    )


def lineitem_log(spark: SparkSession, sf_dir: str, num_ranges: int | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % LINEITEM_PARTITIONS).cast("int").alias("part"),
        *LINEITEM_ORDER, "l_quantity", "l_returnflag", "l_linestatus")
    numbered = index_within(li, ["part"], LINEITEM_ORDER, out="off", num_ranges=num_ranges,
                            group_bound=LINEITEM_PARTITIONS)
    return numbered.select(
        "part", "off",
        F.col("l_shipdate").alias("publish_time"),
        F.lit(None).cast("timestamp_ntz").alias("event_time"),
        F.concat(F.lit('{"k": '), F.col("l_quantity").cast("bigint").cast("string"), F.lit("}")).alias("data"),
        F.concat("l_returnflag", "l_linestatus").alias("attr"),
        F.col("l_extendedprice").alias("value"),
    )


def write_log(log: DataFrame, path: str, mode: str = "error") -> None:
    """Persist a log as ``path/part=K/*.parquet``, sorted by offset inside each file so row-group
    statistics on ``off`` prune seeks.  Range-partitioned on (part, off): a hot partition is
    written by many tasks, each a contiguous offset range."""
    (log.select([f.name for f in LOG_SCHEMA.fields])
        .repartitionByRange("part", "off")
        .sortWithinPartitions("part", "off")
        .write.mode(mode).partitionBy("part").parquet(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Read a log folder written by :func:`write_log` (``part`` comes from the directory names)."""
    df = spark.read.schema(LOG_SCHEMA).parquet(path)
    return df.select([f.name for f in LOG_SCHEMA.fields])


#: Bands of start offsets in one seek, and the most partitions whose start rows are read to form them.
SEEK_BANDS = 16
SEEK_ROWS = 100_000


def seek_bands(starts: DataFrame) -> list[tuple[int, list[int]]]:
    """``(least start, partitions)`` for up to ``SEEK_BANDS`` groups of partitions with near start offsets.
    One row per partition is read, ``SEEK_ROWS`` at most; a topic with more partitions is one band."""
    rows = starts.select("part", "start_off").limit(SEEK_ROWS + 1).collect()
    if len(rows) > SEEK_ROWS:
        return []
    rows = sorted((int(r["start_off"]), int(r["part"])) for r in rows)
    step = max(1, -(-len(rows) // SEEK_BANDS))
    return [(rows[i][0], [p for _, p in rows[i:i + step]]) for i in range(0, len(rows), step)]


def read_log_between(spark: SparkSession, path: str, starts: DataFrame, stops: DataFrame | None = None,
                     inclusive: bool = True) -> DataFrame:
    """Rows of a written log from each partition's start offset on (and before its stop offset).

    One predicate over all partitions could only push the least start, and a single partition at 0 would
    switch off row-group skipping for all.  So partitions with near starts are read together: every band
    prunes its own ``part=K`` folders and pushes its own bound on ``off`` into the Parquet scan; the exact
    start and stop of each partition are applied by the join of :func:`scan_from` / :func:`scan_between`."""
    from tidelog.sources.scan import scan_between, scan_from

    log = read_log(spark, path)
    bands = seek_bands(starts)
    if bands:
        pieces = [log.where(F.col("part").isin(parts) & (F.col("off") >= least)) for least, parts in bands]
        log = pieces[0]
        for piece in pieces[1:]:
            log = log.unionByName(piece)
    if stops is None:
        return scan_from(log, starts, inclusive=inclusive)
    return scan_between(log, starts, stops)
