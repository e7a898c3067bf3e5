"""Full messages: payload and ordering key as bytes, attributes with repeated values.

A **message log** has the columns of :data:`tidelog.schema.MESSAGE_DDL`.  Nothing in it need be text: ``key`` and
``data`` are ``BINARY`` and every attribute is a list of byte strings in the order they were given.  On disk it is
laid out like any log (``path/part=K/*.parquet`` by offset), so seeks and positions work on it unchanged.

:func:`serialized_size` is the length of a message in the length-delimited wire form that a publisher's byte budget
counts: fields ``key`` 1, ``data`` 2, ``attributes`` 3 (a map entry of name and repeated values), ``event_time`` 4
(seconds and nanoseconds); empty scalars are left out, lengths and numbers are base-128 varints.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.timestamps import epoch_ms, from_epoch_ms, ms
from tidelog.operators.ordered import index_within
from tidelog.schema import DEFAULT_MAX_OUTSTANDING_BYTES, MESSAGE_SCHEMA, require_columns

ATTRIBUTES = "map<string,array<binary>>"


def to_messages(records: DataFrame, data: Column, part: Column, key: Column | None = None,
                attributes: Column | None = None, event_time: Column | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """``part, event_time, key, data, attributes`` (and ``keep``) of every record.

    Text given as ``data`` or ``key`` is taken as its UTF-8 bytes.  A missing key is the empty key, missing attributes are
    the empty map, a null payload is the empty payload, as on the wire; a missing event time stays null."""
    none = F.lit(None)
    empty = F.lit(b"")
    return records.select(
        part.cast("int").alias("part"),
        (ms(event_time) if event_time is not None else none.cast("timestamp_ntz")).alias("event_time"),
        F.coalesce(key.cast("binary") if key is not None else none.cast("binary"), empty).alias("key"),
        F.coalesce(data.cast("binary"), empty).alias("data"),
        F.coalesce(attributes if attributes is not None else none.cast(ATTRIBUTES),
                   F.from_json(F.lit("{}"), ATTRIBUTES)).cast(ATTRIBUTES).alias("attributes"),
        *keep)


def publish_messages(messages: DataFrame, order_cols: Sequence[str | Column], publish_ms: int,
                     num_partitions: int | None = None) -> DataFrame:
    """The message log a broker would store: offsets from 0 in ``order_cols`` order, and a publish time."""
    require_columns(messages, ["part", "event_time", "key", "data", "attributes"], "messages")
    numbered = index_within(messages, ["part"], list(order_cols), out="off", group_bound=num_partitions)
    return (numbered.withColumn("publish_time", from_epoch_ms(F.lit(int(publish_ms))))
            .select([f.name for f in MESSAGE_SCHEMA.fields]))


def write_messages(messages: DataFrame, path: str, mode: str = "error") -> None:
    """Persist a message log, range-partitioned and sorted by ``(part, off)``."""
    (messages.select([f.name for f in MESSAGE_SCHEMA.fields])
     .repartitionByRange("part", "off").sortWithinPartitions("part", "off")
     .write.mode(mode).partitionBy("part").parquet(path))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path).select([f.name for f in MESSAGE_SCHEMA.fields])


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def _varint(n: Column) -> Column:
    """Bytes of ``n`` (never null) as a base-128 varint: seven bits a byte; a negative number has 64 bits."""
    return F.floor((F.length(F.bin(n)) + 6) / 7)


def _field(n: Column) -> Column:
    """A length-delimited field of ``n`` bytes: tag, length, content."""
    return _let(n, lambda v: v + _varint(v) + 1)


def _bytes(col: Column) -> Column:
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("bigint")


def serialized_size(df: DataFrame) -> Column:
    """Bytes of every message in wire form (see the module's docstring)."""
    zero = F.lit(0).cast("bigint")

    def optional(col: Column) -> Column:
        return _let(_bytes(col), lambda n: F.when(n > 0, n + _varint(n) + 1).otherwise(zero))

    def entry(acc: Column, e: Column) -> Column:
        values = F.aggregate(F.coalesce(e["value"], F.array().cast("array<binary>")), zero,
                             lambda a, v: a + _field(_bytes(v)))
        return acc + _field(_field(_bytes(e["key"])) + _field(values))

    attributes = F.coalesce(F.aggregate(F.map_entries(df["attributes"]), zero, entry), zero)
    def stamp(t: Column) -> Column:
        rest = F.pmod(t, F.lit(1000)).cast("bigint")
        seconds = F.floor((t - rest) / 1000).cast("bigint")
        return (F.when(seconds != 0, _varint(seconds) + 1).otherwise(zero)
                + F.when(rest != 0, _varint(rest * 1_000_000) + 1).otherwise(zero))

    time = F.when(df["event_time"].isNull(), zero).otherwise(_field(_let(epoch_ms(df["event_time"]), stamp)))
    return optional(df["key"]) + optional(df["data"]) + attributes + time


def message_bytes(messages: DataFrame, budget: int = DEFAULT_MAX_OUTSTANDING_BYTES) -> DataFrame:
    """``part, n, bytes, accounted``: serialized bytes per partition and what a byte budget counts of them."""
    size = serialized_size(messages)
    return messages.select("part", size.alias("_size")).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_size").alias("bytes"),
        F.sum(F.least("_size", F.lit(int(budget)).cast("bigint"))).alias("accounted"))
