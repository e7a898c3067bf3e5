"""Sink: encoding, event-time choice, byte budget, routing, publish and read back."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidelog.functions import timestamps as tsf
from tidelog.functions.routing import route_str
from tidelog.operators import sink as snk
from tidelog.schema import NO_TIMESTAMP
from tidelog.session import scratch_dir
from tidelog.sources.logs import read_log, write_log


def _recs(spark, items):
    return spark.createDataFrame(items, "value STRING, ts_ms BIGINT, wm_ms BIGINT")


def _env(df, now=555):
    return snk.envelope(df, snk.data_only(lambda d: d["value"]), F.col("ts_ms"), F.col("wm_ms"), now, 2,
                        key=F.lit(1))


def test_record_timestamp_is_the_event_time(spark):
    e = _env(_recs(spark, [("message", 10000, None)])).first()
    assert e["data"] == "message" and e["event_time"] == dt.datetime(1970, 1, 1, 0, 0, 10)


def test_watermark_then_wall_clock(spark):
    e = _env(_recs(spark, [("a", None, 7000), ("b", None, NO_TIMESTAMP), ("c", None, None)]), now=3000)
    got = {r["data"]: r["event_time"] for r in e.collect()}
    assert got == {"a": dt.datetime(1970, 1, 1, 0, 0, 7), "b": dt.datetime(1970, 1, 1, 0, 0, 3),
                   "c": dt.datetime(1970, 1, 1, 0, 0, 3)}


def test_sink_event_ms_expression(spark):
    df = spark.createDataFrame([(5, 6), (None, 6), (None, NO_TIMESTAMP), (NO_TIMESTAMP, 1)], "t BIGINT, w BIGINT")
    out = [r[0] for r in df.select(tsf.sink_event_ms(F.col("t"), F.col("w"), F.lit(99))).collect()]
    assert out == [5, 6, 99, 99]


def test_byte_budget_clamps_each_message(spark):
    env = spark.createDataFrame([(0, "one"), (0, "two")], "part INT, data STRING")
    assert rows(snk.accounted_bytes(env, budget=1)) == [(0, 2, 6, 2)]
    assert rows(snk.accounted_bytes(env)) == [(0, 2, 6, 6)]


def test_watermark_by_batch(spark):
    df = spark.createDataFrame([(0, None), (0, 5), (1, None), (2, 3), (2, None)], "batch INT, ts_ms BIGINT")
    got = rows(snk.watermark_by_batch(df, "batch", "ts_ms"), "batch", "wm_ms")
    assert got == [(0, NO_TIMESTAMP), (0, NO_TIMESTAMP), (1, 5), (2, 5), (2, 5)]


def test_string_routing_is_stable_and_in_range(spark):
    df = spark.createDataFrame([("alpha",), ("beta",), ("alpha",)], "k STRING")
    ps = [r[0] for r in df.select(route_str(F.col("k"), 7)).collect()]
    assert ps[0] == ps[2] and all(0 <= p < 7 for p in ps)


def test_publish_write_read_roundtrip(spark):
    items = [(str(i), i % 2, i) for i in range(100)]
    recs = spark.createDataFrame(items, "value STRING, k INT, n INT")
    env = snk.envelope(recs, snk.data_only(lambda d: d["value"]), None, None, 0, 2, key=F.col("k"))
    env = env.withColumn("n", F.col("data").cast("int"))
    log = snk.publish(env, ["n"], 1000, num_partitions=2)
    path = scratch_dir(spark, "test-roundtrip")
    write_log(log, path)
    back = read_log(spark, path)
    assert sorted(r["data"] for r in back.collect()) == sorted(str(i) for i in range(100))
    assert rows(back.groupBy("part").agg(F.max("off"), F.count("*"))) == [(0, 49, 50), (1, 49, 50)]
