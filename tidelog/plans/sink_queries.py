"""Sink side over ``orders``: envelopes, event-time choice, routing, byte budget, round trip.

Records arrive in ``o_orderkey`` order, in batches of 1,000 keys; the record time is
``o_orderdate`` except for every fourth order, which carries none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import decode as dec
from tidelog.functions.timestamps import epoch_ms, sink_event_ms
from tidelog.operators import sink as snk
from tidelog.plans.registry import REGISTRY, register
from tidelog.session import scratch_dir
from tidelog.sources.logs import read_log, table, write_log

PARTS = 4
BUDGET = 64                      # bytes; small so that large messages are clamped
NOW_MS = 1_767_225_600_000       # the wall clock a test pins (2026-01-01T00:00:00Z)
BATCH = 1000
VALUE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]

_JSON_SQL = ("to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey, "
             "'o_orderstatus': o_orderstatus, 'o_orderpriority': o_orderpriority})")
_ENV_SQL = f"""env AS (
  SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(o_custkey % {PARTS} AS INTEGER) AS part,
         CAST({_JSON_SQL} AS VARCHAR) AS data, CAST(NULL AS VARCHAR) AS attr,
         date_trunc('millisecond', o_orderdate) AS event_time, o_orderkey
  FROM orders)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return snk.envelope(o, snk.data_only(snk.json_value(VALUE_COLS)), epoch_ms(F.col("o_orderdate")), None,
                        NOW_MS, PARTS, key=F.col("o_custkey"))


@register("sink_envelope", f"WITH {_ENV_SQL} SELECT key, part, data, attr, event_time FROM env")
def sink_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-only encoding: JSON payload, event time = record time, routed by customer key."""
    return _envelope(spark, sf_dir)


@register("sink_envelope_custom", f"""
SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(o_custkey % {PARTS} AS INTEGER) AS part,
       o_orderstatus || '|' || o_orderpriority AS data, o_orderstatus AS attr,
       date_trunc('day', o_orderdate) AS event_time FROM orders""")
def sink_envelope_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full encoder: payload, attribute and event time chosen by the user."""
    o = _orders(spark, sf_dir)

    def encoder(df: DataFrame):
        return {"data": F.concat_ws("|", df["o_orderstatus"], df["o_orderpriority"]),
                "attr": df["o_orderstatus"],
                "event_time": F.to_date(df["o_orderdate"]).cast("timestamp_ntz")}
    return snk.envelope(o, encoder, None, None, NOW_MS, PARTS, key=F.col("o_custkey"))


@register("sink_timestamp", f"""
WITH r AS (SELECT o_orderkey, o_orderkey // {BATCH} AS batch,
                  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE epoch_ms(o_orderdate) END AS ts_ms FROM orders),
b AS (SELECT batch, max(ts_ms) AS bmax FROM r GROUP BY batch),
w AS (SELECT batch, coalesce(max(bmax) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                           CAST(-9223372036854775808 AS BIGINT)) AS wm_ms FROM b)
SELECT o_orderkey AS off, coalesce(nullif(coalesce(ts_ms, wm_ms), CAST(-9223372036854775808 AS BIGINT)), {NOW_MS}) AS ts_ms
FROM r LEFT JOIN w USING (batch)""")
def sink_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time per record: its own time, else the watermark, else the wall clock."""
    o = (_orders(spark, sf_dir)
         .select("o_orderkey", F.expr(f"o_orderkey div {BATCH}").alias("batch"),
                 F.when(F.col("o_orderkey") % 4 != 0, epoch_ms(F.col("o_orderdate"))).alias("ts_ms")))
    w = snk.watermark_by_batch(o, "batch", "ts_ms")
    return w.select(F.col("o_orderkey").alias("off"),
                    sink_event_ms(F.col("ts_ms"), F.col("wm_ms"), F.lit(NOW_MS).cast("bigint")).alias("ts_ms"))


@register("accounted_bytes", f"""WITH {_ENV_SQL}
SELECT part, count(*) AS n, CAST(sum(strlen(data)) AS BIGINT) AS bytes,
       CAST(sum(least(strlen(data), {BUDGET})) AS BIGINT) AS accounted FROM env GROUP BY part""")
def accounted_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per partition and what a 64-byte budget accounts for."""
    return snk.accounted_bytes(_envelope(spark, sf_dir), BUDGET)


@register("sink_routing", f"WITH {_ENV_SQL} SELECT part, count(*) AS n FROM env GROUP BY part")
def sink_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per partition with integer-key routing."""
    return snk.routing_counts(_envelope(spark, sf_dir))


@register("sink_routing_str", """
SELECT CAST(CAST(('0x' || substr(md5(c_name), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS part, count(*) AS n
FROM customer GROUP BY ALL""")
def sink_routing_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per partition with string-key (MD5) routing of customer names on 5 partitions."""
    c = table(spark, sf_dir, "customer")
    env = snk.envelope(c, snk.data_only(snk.json_value(["c_custkey"])), None, None, NOW_MS, 5,
                       key=F.col("c_name"), key_kind="str")
    return snk.routing_counts(env)


@register("sink_round_robin", f"""
SELECT CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % {PARTS} AS INTEGER) AS part, o_orderkey FROM orders""")
def sink_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a key are dealt round-robin in arrival order."""
    o = snk.round_robin_rank(_orders(spark, sf_dir), ["o_orderkey"])
    env = snk.envelope(o, snk.data_only(snk.json_value(["o_orderkey"])), None, None, NOW_MS, PARTS,
                       rank=F.col("_rank"))
    return env.select("part", dec.json_field("o_orderkey")(F.col("data")).alias("o_orderkey"))


@register("sink_roundtrip", f"""WITH {_ENV_SQL}
SELECT part, row_number() OVER (PARTITION BY part ORDER BY o_orderkey) - 1 AS off, o_orderkey, event_time FROM env""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders encoded, published (offsets per partition), written as a log, read back and decoded."""
    env = _envelope(spark, sf_dir).withColumn("_k", dec.json_field("o_orderkey")(F.col("data")))
    log = snk.publish(env, ["_k"], NOW_MS, num_partitions=PARTS)
    path = scratch_dir(spark, "sink-log")
    write_log(log, path)
    back = read_log(spark, path)
    return back.select("part", "off", dec.json_field("o_orderkey")(F.col("data")).alias("o_orderkey"), "event_time")


@register("stream_sink_roundtrip", REGISTRY["sink_roundtrip"][1])
def stream_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders streamed into a log folder by the streaming log sink (offsets per partition,
    exactly once per batch), read back and decoded."""
    from tidelog.options import LogSinkOptions
    from tidelog.streaming.sink import start_log_sink
    from tidelog.streaming.stream import table_stream

    opts = LogSinkOptions("topics/orders", PARTS, encoder=snk.data_only(snk.json_value(VALUE_COLS)))
    path = scratch_dir(spark, "stream-sink-log")
    q = start_log_sink(table_stream(spark, sf_dir, "orders"), path, opts, scratch_dir(spark, "stream-sink-ck"),
                       [dec.json_field("o_orderkey")(F.col("data"))], key=F.col("o_custkey"),
                       ts_ms=epoch_ms(F.col("o_orderdate")), publish_ms=NOW_MS)
    q.awaitTermination()
    back = read_log(spark, path)
    return back.select("part", "off", dec.json_field("o_orderkey")(F.col("data")).alias("o_orderkey"), "event_time")


@register("stream_sink_round_robin", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders)
SELECT CAST(k % {PARTS} AS INTEGER) AS part, k // {PARTS} AS off, o_orderkey FROM r""")
def stream_sink_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a key streamed into a log folder: dealt round robin, offsets in order."""
    from tidelog.options import LogSinkOptions
    from tidelog.streaming.sink import start_log_sink
    from tidelog.streaming.stream import table_stream

    opts = LogSinkOptions("topics/orders", PARTS, encoder=snk.data_only(snk.json_value(["o_orderkey"])))
    path = scratch_dir(spark, "stream-round-robin")
    q = start_log_sink(table_stream(spark, sf_dir, "orders"), path, opts, scratch_dir(spark, "stream-round-robin-ck"),
                       [dec.json_field("o_orderkey")(F.col("data"))], publish_ms=NOW_MS, rank_order=["o_orderkey"])
    q.awaitTermination()
    return read_log(spark, path).select("part", "off", dec.json_field("o_orderkey")(F.col("data")).alias("o_orderkey"))


@register("stream_sink_timestamp", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN epoch_ms(o_orderdate) END AS ts, o_orderkey % 2 AS b FROM orders),
w AS (SELECT max(ts) AS wm FROM o WHERE b = 0)
SELECT o_orderkey, coalesce(ts, CASE WHEN b = 1 THEN wm END, {NOW_MS})::BIGINT AS event_ms FROM o, w""")
def stream_sink_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of orders, every third without a time: record time, else the watermark of the
    deliveries before, else the wall clock."""
    from tidelog.options import LogSinkOptions
    from tidelog.streaming.sink import start_log_sink

    opts = LogSinkOptions("topics/orders", PARTS, encoder=snk.data_only(snk.json_value(["o_orderkey"])))
    path, inbox, ck = scratch_dir(spark, "stream-ts"), scratch_dir(spark, "stream-ts-inbox"), scratch_dir(spark, "stream-ts-ck")
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    ts = F.when(F.col("o_orderkey") % 3 != 0, epoch_ms(F.col("o_orderdate")))
    for b in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == b).write.parquet(f"{inbox}/{b}")
        stream = spark.readStream.schema(orders.schema).parquet(f"{inbox}/*")
        q = start_log_sink(stream, path, opts, ck, [dec.json_field("o_orderkey")(F.col("data"))], key=F.col("o_orderkey"),
                           ts_ms=ts, publish_ms=NOW_MS)
        q.awaitTermination()
    return read_log(spark, path).select(dec.json_field("o_orderkey")(F.col("data")).alias("o_orderkey"),
                                        epoch_ms(F.col("event_time")).alias("event_ms"))
