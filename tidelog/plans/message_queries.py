"""Whole messages over ``orders`` and ``events``: bytes, keys and attributes, serialized sizes, flush groups, codecs,
a partition count that changes.

An order's message: key = customer number as text, data = the bytes FF 00 and the priority, attributes ``status`` (one
value) and ``words`` (status and priority, in that order), event time = order date, partition = customer modulo 4.
"""

from __future__ import annotations

import json
import struct
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import decode as dec
from tidelog.functions.routing import partitions_at
from tidelog.functions.timestamps import epoch_ms
from tidelog.operators import messages as msg
from tidelog.operators import sink as snk
from tidelog.operators.codec import MessageDecoder, MessageEncoder, decode_with, encode_with
from tidelog.operators.flush import flush_groups
from tidelog.plans.registry import register
from tidelog.plans.sink_queries import NOW_MS, PARTS
from tidelog.session import scratch_dir
from tidelog.sources.logs import read_log, table
from tidelog.streaming.stream import message_stream, run_to_files, table_stream

FLUSH_BUDGET = 2000        # bytes
GROWS_AT = "1996-01-01"    # from this order date on the topic has ...
GROWN = 6                  # ... six partitions


def _varint_sql(n: str) -> str:
    return f"(1 + ({n} >= 128)::INT + ({n} >= 16384)::INT + ({n} >= 2097152)::INT + ({n} >= 268435456)::INT + ({n} >= 34359738368)::INT)"


def _field_sql(n: str) -> str:
    return f"({n} + {_varint_sql(f'({n})')} + 1)"


def _entry_sql(name: int, values: list[str]) -> str:
    """Bytes of one attribute: its name has ``name`` bytes, its values are these lengths."""
    inner = " + ".join(_field_sql(v) for v in values)
    return _field_sql(f"{_field_sql(str(name))} + {_field_sql(inner)}")


# dates before 2004 that are whole seconds: varint of the seconds, no nanoseconds
_STATUS, _PRIORITY = "strlen(o_orderstatus)", "strlen(o_orderpriority)"
_SIZE_SQL = (f"{_field_sql('strlen(CAST(o_custkey AS VARCHAR))')} + {_field_sql(f'({_PRIORITY} + 2)')} + {_entry_sql(6, [_STATUS])} "
             f"+ {_entry_sql(5, [_STATUS, _PRIORITY])} + {_field_sql('(1 + ' + _varint_sql('epoch(o_orderdate)::BIGINT') + ')')}")
_SIZED_SQL = f"""sized AS MATERIALIZED (
  SELECT CAST(o_custkey % {PARTS} AS INTEGER) AS part, o_orderkey, CAST({_SIZE_SQL} AS BIGINT) AS size FROM orders)"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    text = lambda c: F.col(c).cast("binary")                                            # noqa: E731
    attributes = F.map_from_arrays(F.array(F.lit("status"), F.lit("words")),
                                   F.array(F.array(text("o_orderstatus")), F.array(text("o_orderstatus"), text("o_orderpriority"))))
    return msg.to_messages(o, F.concat(F.lit(b"\xff\x00"), text("o_orderpriority")), F.col("o_custkey") % PARTS,
                           F.col("o_custkey").cast("string"), attributes, F.col("o_orderdate"), keep=["o_orderkey"])


@register("message_bytes", f"""WITH {_SIZED_SQL}
SELECT part, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, CAST(sum(least(size, 64)) AS BIGINT) AS accounted FROM sized GROUP BY part""")
def message_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serialized bytes of the orders' messages per partition, and what a 64-byte budget counts."""
    return msg.message_bytes(_messages(spark, sf_dir), 64)


@register("flush_groups", f"""WITH RECURSIVE {_SIZED_SQL},
r AS MATERIALIZED (
  SELECT part, off, size, CAST(sum(size) OVER w - size AS BIGINT) AS b, CAST(sum(size) OVER w AS BIGINT) AS e
  FROM (SELECT part, size, row_number() OVER (PARTITION BY part ORDER BY o_orderkey) - 1 AS off FROM sized)
  WINDOW w AS (PARTITION BY part ORDER BY off)),
succ AS MATERIALIZED (
  SELECT x.part, x.off, CASE WHEN y.e > x.b + {FLUSH_BUDGET} THEN y.off END AS nxt
  FROM r x ASOF JOIN r y ON x.part = y.part AND x.b + {FLUSH_BUDGET} >= y.b),
chain AS (
  SELECT part, 0::BIGINT AS grp, 0::BIGINT AS off FROM (SELECT DISTINCT part FROM r)
  UNION ALL
  SELECT c.part, c.grp + 1, s.nxt FROM chain c JOIN succ s ON s.part = c.part AND s.off = c.off WHERE s.nxt IS NOT NULL),
cut AS (SELECT part, grp, off, lead(off) OVER (PARTITION BY part ORDER BY grp) AS nxt FROM chain)
SELECT c.part, c.grp, min(r.off) AS first_off, max(r.off) AS last_off, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes,
       CAST(sum(size) AS BIGINT) AS accounted
FROM cut c JOIN r ON r.part = c.part AND r.off >= c.off AND (c.nxt IS NULL OR r.off < c.nxt) GROUP BY c.part, c.grp""")
def flush_groups_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups in which the orders' messages are outstanding together under a budget of 2,000 serialized bytes."""
    log = msg.publish_messages(_messages(spark, sf_dir), ["o_orderkey"], NOW_MS, PARTS)
    return flush_groups(log, msg.serialized_size(log), FLUSH_BUDGET, part_bound=PARTS)


@register("message_log_roundtrip", f"""
SELECT CAST(o_custkey % {PARTS} AS INTEGER) AS part, row_number() OVER (PARTITION BY o_custkey % {PARTS} ORDER BY o_orderkey) - 1 AS off,
       hex(encode(CAST(o_custkey AS VARCHAR))) AS key_hex, hex(from_hex('FF00') || encode(o_orderpriority)) AS data_hex,
       o_orderstatus AS status, o_orderstatus || '|' || o_orderpriority AS words, date_trunc('millisecond', o_orderdate) AS event_time
FROM orders""")
def message_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' messages written as a message log and streamed back: bytes that are no UTF-8, keys and repeated
    attribute values come back as they were."""
    path, out = scratch_dir(spark, "message-log"), scratch_dir(spark, "message-log-out")
    msg.write_messages(msg.publish_messages(_messages(spark, sf_dir), ["o_orderkey"], NOW_MS, PARTS), path)
    values = lambda name: F.array_join(F.transform(F.col("attributes")[name], lambda v: v.cast("string")), "|")
    run_to_files(message_stream(spark, path).select(
        "part", "off", F.hex("key").alias("key_hex"), F.hex("data").alias("data_hex"), values("status").alias("status"),
        values("words").alias("words"), "event_time"), out, scratch_dir(spark, "message-log-ck"))
    return spark.read.parquet(out)


class PropsDecoder(MessageDecoder):
    """JSON objects by a parser of the task's own: number ``k`` and the length of the payload."""

    ddl = "struct<k bigint, n int>"
    columns = ("data",)

    def open(self):
        self.parser = json.JSONDecoder()

    def decode(self, message):
        try:
            return {"k": self.parser.decode(message["data"].decode())["k"], "n": len(message["data"])}
        except ValueError:
            return None


@register("codec_decode", """
SELECT CAST(user_id % 8 AS INTEGER) AS part, event_id AS off, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(strlen(props) AS INTEGER) AS n FROM events WHERE event_id % 10 <> 7""")
def codec_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload bytes of the events log through a codec of the user's own; what it cannot decode is skipped."""
    from tidelog.sources.logs import events_log

    log = events_log(spark, sf_dir).select("part", "off", F.col("data").cast("binary").alias("data"))
    return decode_with(log, PropsDecoder(), keep=["part", "off"]).where("value is not null").select("part", "off", "value.k", "value.n")


class _Packed:
    """Number pairs and a text, packed and deflated with a dictionary that both ends set up in ``open()``."""

    def open(self):
        self.head = struct.Struct(">qq")
        self.words = b"1-URGENT2-HIGH3-MEDIUM4-NOT SPECIFIED5-LOW"


class OrderEncoder(_Packed, MessageEncoder):
    columns = ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")

    def encode(self, record):
        # the least window that holds the dictionary and a body, and little state: both are set up for every order
        z = zlib.compressobj(wbits=9, memLevel=1, zdict=self.words)
        body = self.head.pack(record["o_orderkey"], record["o_custkey"]) + record["o_orderpriority"].encode()
        spoiled = b"\xff" if record["o_orderkey"] % 10 == 7 else b""
        return {"key": struct.pack(">q", record["o_custkey"]), "data": spoiled + z.compress(body) + z.flush(),
                "attributes": {"status": [record["o_orderstatus"].encode()] * 2}, "event_time": record["o_orderdate"]}


class OrderDecoder(_Packed, MessageDecoder):
    ddl = "struct<o_orderkey bigint, o_custkey bigint, priority string, status string>"
    columns = ("data", "attributes")

    def decode(self, message):
        try:
            body = zlib.decompressobj(zdict=self.words).decompress(message["data"])
        except zlib.error:
            return None
        order, customer = self.head.unpack_from(body)
        status = b"".join(dict(message["attributes"])["status"])
        return {"o_orderkey": order, "o_custkey": customer, "priority": body[self.head.size:].decode(), "status": status.decode()}


@register("codec_roundtrip", f"""
WITH m AS (SELECT *, row_number() OVER (PARTITION BY o_custkey % {PARTS} ORDER BY o_orderkey) - 1 AS off FROM orders)
SELECT CAST(o_custkey % {PARTS} AS INTEGER) AS part, off, date_trunc('millisecond', o_orderdate) AS event_time,
       CASE WHEN o_orderkey % 10 <> 7 THEN o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 10 <> 7 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 10 <> 7 THEN o_orderpriority END AS priority,
       CASE WHEN o_orderkey % 10 <> 7 THEN o_orderstatus || o_orderstatus END AS status FROM m""")
def codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through a codec with state into a written message log and back; every tenth payload is spoiled on the way and
    comes back as null, its position kept."""
    enc = encode_with(table(spark, sf_dir, "orders"), OrderEncoder(), keep=["o_orderkey", "o_custkey"])
    m = msg.to_messages(enc, F.col("data"), F.col("o_custkey") % PARTS, F.col("key"), F.col("attributes"), F.col("event_time"), keep=["o_orderkey"])
    path = scratch_dir(spark, "codec-log")
    msg.write_messages(msg.publish_messages(m, ["o_orderkey"], NOW_MS, PARTS), path)
    return (decode_with(msg.read_messages(spark, path), OrderDecoder(), keep=["part", "off", "event_time"])
            .select("part", "off", "event_time", "value.*"))


_GROWN_SQL = f"(o_custkey % CASE WHEN o_orderdate < TIMESTAMP '{GROWS_AT}' THEN {PARTS} ELSE {GROWN} END)::INTEGER"


def _grows_at_ms(spark: SparkSession) -> int:
    return spark.range(1).select(epoch_ms(F.lit(GROWS_AT).cast("timestamp_ntz"))).first()[0]


@register("sink_partition_history", f"SELECT {_GROWN_SQL} AS part, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1")
def sink_partition_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders routed by customer while the topic grows from four to six partitions."""
    o = table(spark, sf_dir, "orders")
    counts = partitions_at(epoch_ms(F.col("o_orderdate")), [(0, PARTS), (_grows_at_ms(spark), GROWN)])
    env = snk.envelope(o, snk.data_only(snk.json_value(["o_orderkey"])), None, None, NOW_MS, counts, key=F.col("o_custkey"))
    return env.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(dec.json_field("o_orderkey")(F.col("data"))).alias("first_key"))


@register("stream_sink_partition_history", f"""
SELECT {_GROWN_SQL} AS part, row_number() OVER (PARTITION BY {_GROWN_SQL} ORDER BY o_orderkey) - 1 AS off, o_orderkey FROM orders""")
def stream_sink_partition_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream over the change from four to six partitions: the sink reads the topic's history in every batch."""
    from tidelog.options import LogSinkOptions
    from tidelog.streaming.sink import start_log_sink

    history, path = scratch_dir(spark, "partition-history"), scratch_dir(spark, "grown-log")
    spark.createDataFrame([(0, PARTS), (_grows_at_ms(spark), GROWN)], "from_ms BIGINT, count INT").write.parquet(history)
    opts = LogSinkOptions("topics/orders", PARTS, encoder=snk.data_only(snk.json_value(["o_orderkey"])))
    key = dec.json_field("o_orderkey")
    start_log_sink(table_stream(spark, sf_dir, "orders"), path, opts, scratch_dir(spark, "grown-log-ck"), [key(F.col("data"))],
                   key=F.col("o_custkey"), publish_ms=NOW_MS, history=history, at_ms=epoch_ms(F.col("o_orderdate"))).awaitTermination()
    return read_log(spark, path).select("part", "off", key(F.col("data")).alias("o_orderkey"))
