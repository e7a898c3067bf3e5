"""Writing side: encode records to messages, stamp event time, route, account bytes, publish.

A sink record is any DataFrame; the encoder maps it to message columns (``data`` and optional
``attr`` / ``event_time``).  Data-only encoding sets ``data = encode(value)`` and
``event_time = record time`` in milliseconds.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.routing import route_int, route_round_robin, route_str
from tidelog.functions.timestamps import from_epoch_ms, ms, sink_event_ms
from tidelog.operators.broadcast import BROADCAST_ROW_LIMIT, broadcast_bounded
from tidelog.operators.ordered import index_within, prefix_max
from tidelog.schema import DEFAULT_MAX_OUTSTANDING_BYTES, NO_TIMESTAMP

Encoder = Callable[[DataFrame], dict[str, Column]]


def data_only(value: Callable[[DataFrame], Column]) -> Encoder:
    """Encoder writing only the payload; event time is the record time."""
    return lambda df: {"data": value(df)}


def json_value(cols: Sequence[str]) -> Callable[[DataFrame], Column]:
    """Payload = JSON object of the given columns."""
    return lambda df: F.to_json(F.struct(*[df[c] for c in cols]))


def watermark_by_batch(records: DataFrame, batch: str, ts_ms: str, out: str = "wm_ms") -> DataFrame:
    """``out`` = the watermark seen while writing ``batch``: the max record time of all earlier
    batches (no lateness allowed); the "no timestamp" sentinel before any record time was seen.
    The per-batch table is small (one row per batch) and is carried in chunks of 1,024 batches."""
    per = records.groupBy(batch).agg(F.max(ts_ms).alias("_bmax"))
    wm = prefix_max(per.withColumn("_one", F.lit(0)), ["_one"], [batch], "_bmax",
                    F.expr(f"cast(`{batch}` as bigint) div 1024"), "_wm", inclusive=False)
    wm = wm.select(batch, F.coalesce("_wm", F.lit(NO_TIMESTAMP).cast("bigint")).alias(out))
    # one row per batch: measured (capped count) and broadcast when small, so the records are not
    # shuffled and a batch holding most of them does not land in one task
    n = wm.limit(BROADCAST_ROW_LIMIT + 1).count()
    return records.join(broadcast_bounded(wm, n), batch, "left")


def envelope(records: DataFrame, encoder: Encoder, ts_ms: Column | None, watermark_ms: Column | None,
             now_ms: int | Column, num_partitions: int | Column, key: Column | None = None,
             key_kind: str = "int", rank: Column | None = None) -> DataFrame:
    """``key, part, data, attr, event_time`` for every record.

    Event time = record time, else the current watermark, else (sentinel or missing) ``now_ms``.
    Routing: integer key ``pmod(key, n)``, string key MD5-based, no key round-robin by ``rank``.
    """
    now = now_ms if isinstance(now_ms, Column) else F.lit(int(now_ms)).cast("bigint")
    chosen = sink_event_ms(ts_ms if ts_ms is not None else F.lit(None).cast("bigint"),
                           watermark_ms if watermark_ms is not None else F.lit(None).cast("bigint"), now)
    enc = encoder(records)
    if key is None:
        if rank is None:
            raise ValueError("records without a key need a rank for round-robin routing")
        part = route_round_robin(rank, num_partitions)
    elif key_kind == "str":
        part = route_str(key, num_partitions)
    else:
        part = route_int(key, num_partitions)
    event_time = enc.get("event_time", from_epoch_ms(chosen))
    return records.select(
        (key.cast("string") if key is not None else F.lit(None).cast("string")).alias("key"),
        part.alias("part"),
        enc["data"].cast("string").alias("data"),
        enc.get("attr", F.lit(None).cast("string")).alias("attr"),
        ms(event_time).alias("event_time"))


def accounted_bytes(env: DataFrame, budget: int = DEFAULT_MAX_OUTSTANDING_BYTES) -> DataFrame:
    """``part, n, bytes, accounted``: payload bytes per partition and what the byte budget counts
    (a message larger than the budget is counted as the whole budget)."""
    size = F.octet_length("data")
    return env.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(size).cast("bigint").alias("bytes"),
        F.sum(F.least(size, F.lit(int(budget)))).cast("bigint").alias("accounted"))


def routing_counts(env: DataFrame) -> DataFrame:
    return env.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def publish(env: DataFrame, order_cols: Sequence[str | Column], publish_ms: int,
            num_ranges: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Give each message its partition offset, in ``order_cols`` order, and a publish time: the
    log rows a broker would store.  Offsets continue from 0 in every partition."""
    numbered = index_within(env, ["part"], list(order_cols), out="off", num_ranges=num_ranges,
                            group_bound=num_partitions)
    return numbered.select(
        F.col("part").cast("int").alias("part"), "off",
        from_epoch_ms(F.lit(int(publish_ms))).alias("publish_time"),
        "event_time", "data", "attr", F.lit(None).cast("double").alias("value"))


def round_robin_rank(records: DataFrame, order_cols: Sequence[str], out: str = "_rank") -> DataFrame:
    """Arrival rank of every record (global, range-partitioned)."""
    return index_within(records, [], list(order_cols), out=out, group_bound=0)


def encode_for(records: DataFrame, options, ts_ms: Column | None = None, watermark_ms: Column | None = None,
               now_ms: int | Column | None = None, key: Column | None = None, key_kind: str = "int",
               rank: Column | None = None, num_partitions: Column | None = None) -> DataFrame:
    """Envelope under ``options`` (:class:`tidelog.options.LogSinkOptions`): its encoder (default:
    the ``value`` column as text) and partition count (or the count ``num_partitions`` of each
    record); ``now_ms`` defaults to the current time."""
    import time

    enc = options.encoder or data_only(lambda df: df["value"].cast("string"))
    now = now_ms if now_ms is not None else int(time.time() * 1000)
    return envelope(records, enc, ts_ms, watermark_ms, now,
                    options.num_partitions if num_partitions is None else num_partitions, key=key,
                    key_kind=key_kind, rank=rank)


def publish_to_log(env: DataFrame, options, path: str, order_cols: Sequence[str], publish_ms: int,
                   append: bool = True) -> DataFrame:
    """Publish an envelope to the log folder ``path`` (offsets continue after what is there, read
    from the Parquet footers) and return the per-partition byte accounting of what was written."""
    from tidelog.sources.logs import write_log

    from tidelog.operators.progress import positions_from_footers
    from tidelog.sources.paths import read_if_there

    spark = env.sparkSession
    numbered = publish(env, order_cols, publish_ms, num_partitions=options.num_partitions)
    heads = []
    if read_if_there(spark, path) is not None:
        # next offset per partition, from the Parquet footers of what is there (no rows read);
        # one row per partition, so it is collected and broadcast
        heads = [(int(r["part"]), int(r["position"]) + 1)
                 for r in positions_from_footers(spark, path).collect()]
    if heads:
        h = spark.createDataFrame(heads, "part INT, _head BIGINT")
        numbered = (numbered.join(F.broadcast(h), "part", "left")
                    .withColumn("off", F.col("off") + F.coalesce("_head", F.lit(0)))
                    .drop("_head"))
    write_log(numbered, path, mode="append" if append else "error")
    return accounted_bytes(numbered, options.max_outstanding_bytes)
