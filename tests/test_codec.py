"""Codecs: one open() per task, skip or fail per message, typed values, round trip through a message log."""

import datetime
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.operators import messages as msg
from tidelog.operators.codec import MessageDecoder, MessageEncoder, decode_with, encode_with
from tidelog.session import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers cannot import a test module


class Counting(MessageDecoder):
    """Value: who decoded, after how many calls of open()."""

    ddl = "struct<task string, opens int, n int>"
    opens = 0

    def open(self):
        self.task, self.opens = str(uuid.uuid4()), self.opens + 1

    def decode(self, message):
        return {"task": self.task, "opens": self.opens, "n": len(message["data"])}


class Ascii(MessageDecoder):
    ddl = "string"

    def decode(self, message):
        if message["data"] == b"boom":
            raise RuntimeError("decoder gave up")
        return message["data"].decode() if message["data"].isascii() else None


class Wire(MessageEncoder):
    def open(self):
        self.prefix = b"\xff\x00"

    def encode(self, record):
        if record["n"] is None:
            return {"data": None}
        return {"key": str(record["n"]).encode(), "data": self.prefix + record["text"].encode(),
                "attributes": {"t": [b"b", b"a", record["text"].encode()]}, "event_time": datetime.datetime(2024, 1, 1, 0, 0, record["n"])}


class Unwire(MessageDecoder):
    ddl = "struct<text string, key string, last string, at timestamp_ntz>"

    def open(self):
        self.prefix = b"\xff\x00"

    def decode(self, m):
        if not m["data"].startswith(self.prefix):
            return None
        return {"text": m["data"][2:].decode(), "key": m["key"].decode(), "last": dict(m["attributes"])["t"][-1].decode(), "at": m["event_time"]}


def test_open_runs_once_per_task(spark):
    m = spark.range(0, 1000, 1, 4).select(F.lit(0).alias("part"), F.col("id").alias("off"), F.lit(b"abc").alias("data"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = decode_with(m, Counting(), keep=["off"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 1000 and {r["value"]["opens"] for r in got} == {1} and len({r["value"]["task"] for r in got}) == 4


def test_skip_and_fail(spark):
    ddl = "part INT, off BIGINT, data BINARY, value INT"
    m = spark.createDataFrame([(0, 1, b"ok", 5), (0, 2, b"\xff", 5)], ddl)
    got = decode_with(m, Ascii())                                   # a column of the output's name gives way
    assert [tuple(r) for r in got.select("off", "value").orderBy("off").collect()] == [(1, "ok"), (2, None)]
    with pytest.raises(Exception, match="cannot decode message at part 0 offset 2"):
        decode_with(m, Ascii(), on_error="fail").collect()
    with pytest.raises(Exception, match="decoder gave up"):
        decode_with(spark.createDataFrame([(0, 1, b"boom", 5)], ddl), Ascii()).collect()
    assert decode_with(m.limit(0), Ascii()).collect() == []
    with pytest.raises(ValueError):
        decode_with(m, Ascii(), on_error="ignore")


def test_round_trip_through_a_message_log(spark):
    rec = spark.createDataFrame([(1, "é"), (2, ""), (None, "x")], "n INT, text STRING")
    enc = encode_with(rec, Wire(), keep=["n"])
    m = msg.to_messages(enc, F.col("data"), F.coalesce(F.col("n") % 2, F.lit(0)), F.col("key"), F.col("attributes"), F.col("event_time"), keep=["n"])
    path = scratch_dir(spark, "codec")
    msg.write_messages(msg.publish_messages(m, ["n"], 0, 2), path)
    got = decode_with(msg.read_messages(spark, path), Unwire(), keep=["part", "off"]).select("part", "off", "value.*")
    at = [datetime.datetime(2024, 1, 1, 0, 0, s) for s in (1, 2)]
    assert got.where("text is null").count() == 1
    assert rows(got.where("text is not null")) == [(0, 1, "", "2", "", at[1]), (1, 0, "é", "1", "é", at[0])]


def test_unknown_message_fields_and_clashing_columns_are_errors(spark):
    class Wrong(MessageEncoder):
        def encode(self, record):
            return {"payload": b""}
    with pytest.raises(Exception, match="a message has the fields"):
        encode_with(spark.range(1), Wrong()).collect()
    with pytest.raises(ValueError, match="clash"):
        encode_with(spark.range(1).withColumn("key", F.lit(1)), Wire(), keep=["key"])


class Names(MessageDecoder):
    """Value: the columns that the decoder is given."""

    ddl = "array<string>"
    columns = ("data",)

    def decode(self, message):
        return sorted(message)


def test_a_codec_is_given_the_columns_it_names(spark):
    ddl = "part INT, off BIGINT, data BINARY, other STRING"
    m = spark.createDataFrame([(0, 1, b"a", "x")], ddl)
    assert [tuple(r) for r in decode_with(m, Names(), keep=["off"]).collect()] == [(1, ["data"])]
    assert [tuple(r) for r in decode_with(m, Names(), on_error="fail", keep=[]).collect()] == [(["data"],)]
    assert decode_with(m, Names()).columns == ["part", "off", "data", "other", "value"]
    with pytest.raises(ValueError, match="missing"):
        decode_with(m.drop("other"), type("Other", (Names,), {"columns": ("other",)})())
