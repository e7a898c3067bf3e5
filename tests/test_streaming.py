"""Streaming: end to end through sink and source with an injected failure, restarts, cursors."""

import os

import pytest
from pyspark.sql import functions as F

from tidelog.functions import decode as dec
from tidelog.operators import sink as snk
from tidelog.operators.records import emitted, to_records
from tidelog.options import FlowControl
from tidelog.session import scratch_dir
from tidelog.sources.logs import write_log
from tidelog.streaming import stream as st


def _publish_ints(spark, path, lo, hi, parts=2):
    recs = spark.range(lo, hi).select(F.col("id").cast("string").alias("value"), F.col("id").alias("n"))
    env = snk.envelope(recs, snk.data_only(lambda d: d["value"]), None, None, 0, parts, key=F.col("n"))
    env = env.withColumn("n", F.col("data").cast("bigint"))
    write_log(snk.publish(env, ["n"], 0, num_partitions=parts), path, mode="append")


def test_end_to_end_with_injected_failure(spark):
    log_dir = scratch_dir(spark, "e2e-log")
    _publish_ints(spark, log_dir, 0, 100)
    out, ck = scratch_dir(spark, "e2e-out"), scratch_dir(spark, "e2e-ck")
    state = {"failed": False}

    def write(batch, batch_id):
        vals = {r["value"] for r in batch.select("value").collect()}
        if "37" in vals and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("injected failure")
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    def start():
        s = st.log_stream(spark, log_dir, FlowControl(bytes_outstanding=1500, messages_outstanding=100))
        r = emitted(to_records(s, dec.data_only(dec.utf8_text())))
        return (r.writeStream.foreachBatch(write).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    q = start()
    with pytest.raises(Exception):
        q.awaitTermination()
    assert state["failed"]
    q = start()
    q.awaitTermination()
    got = [r["value"] for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=int) == [str(i) for i in range(100)]


def test_restart_picks_up_new_data_and_partitions(spark):
    log_dir = scratch_dir(spark, "grow-log")
    _publish_ints(spark, log_dir, 0, 20, parts=2)
    data, cur, ck = scratch_dir(spark, "grow-data"), scratch_dir(spark, "grow-cur"), scratch_dir(spark, "grow-ck")

    def run():
        recs = to_records(st.log_stream(spark, log_dir), dec.data_only(dec.utf8_text()))
        q = st.start_with_cursors(recs, data, cur, ck, emit=emitted)
        q.awaitTermination()

    run()
    first = {r["part"]: r["position"] for r in st.committed_cursors(spark, cur).collect()}
    assert first == {0: 9, 1: 9}
    # more data, and the topic grows to 3 partitions (new offsets continue in old partitions)
    extra = spark.range(20, 29).select(F.col("id").cast("string").alias("data"), F.col("id"))
    rows3 = extra.select((F.col("id") % 3).cast("int").alias("part"),
                         (F.col("id") + 100).alias("off"), F.lit(None).cast("timestamp_ntz").alias("publish_time"),
                         F.lit(None).cast("timestamp_ntz").alias("event_time"), "data",
                         F.lit(None).cast("string").alias("attr"), F.lit(None).cast("double").alias("value"))
    write_log(rows3, log_dir, mode="append")
    run()
    final = {r["part"]: r["position"] for r in st.committed_cursors(spark, cur).collect()}
    assert final == {0: 127, 1: 128, 2: 126}
    values = sorted(int(r["value"]) for r in spark.read.parquet(data).collect())
    assert values == list(range(29))


def test_options_drive_sink_and_source(spark):
    from tidelog.options import LogSinkOptions, LogSourceOptions
    from tidelog.functions import timestamps as tsf

    path = scratch_dir(spark, "opt-log")
    sink = LogSinkOptions("topics/t", num_partitions=3, max_outstanding_bytes=2)
    recs = spark.range(30).select(F.col("id").cast("string").alias("value"), F.col("id").alias("k"))
    acct = snk.publish_to_log(snk.encode_for(recs, sink, key=F.col("k"), now_ms=1000), sink, path,
                              ["data"], publish_ms=5000)
    assert sum(r["n"] for r in acct.collect()) == 30
    assert all(r["accounted"] <= 2 * r["n"] for r in acct.collect())
    # a second publish continues the offsets of every partition
    snk.publish_to_log(snk.encode_for(recs.where("k < 3"), sink, key=F.col("k"), now_ms=1000), sink, path,
                       ["data"], publish_ms=6000)
    cursors = spark.createDataFrame([(0, 9)], "part INT, position BIGINT")
    for resume, want in (("inclusive", [9, 10]), ("exclusive", [10])):
        src = LogSourceOptions("subscriptions/s", FlowControl(10_000, 10), timestamp=tsf.publish_time(),
                               resume=resume)
        s = st.open_log_stream(spark, path, src, cursors=cursors, part_bound=3)
        out, ck = scratch_dir(spark, "opt-out"), scratch_dir(spark, "opt-ck")
        st.run_to_files(s, out, ck)
        back = spark.read.parquet(out)
        # partition 0 holds 10 keys at offsets 0..9 and key 0 again at 10
        assert sorted(r["off"] for r in back.where("part = 0").collect()) == want
        assert back.where("part = 1").count() == 11 and back.where("part = 2").count() == 11
        assert {r["ts"].second for r in back.collect()} == {5, 6}


def test_log_sink_continues_offsets_and_replays_exactly_once(spark):
    from tidelog.options import LogSinkOptions
    from tidelog.sources.logs import read_log
    from tidelog.streaming.sink import log_sink_writer

    inbox = scratch_dir(spark, "sink-inbox")
    for i, (lo, hi) in enumerate(((0, 40), (40, 70), (70, 100))):
        spark.range(lo, hi).select(F.col("id").alias("n")).coalesce(1).write.parquet(f"{inbox}/f{i}")
    opts = LogSinkOptions("topics/t", 3, encoder=snk.data_only(lambda d: d["n"].cast("string")))
    path, ck = scratch_dir(spark, "sink-log"), scratch_dir(spark, "sink-ck")
    writer = log_sink_writer(path, opts, [F.col("data").cast("bigint")], key=F.col("n"), publish_ms=0)
    state = {"failed": False}

    def flaky(batch, batch_id):
        writer(batch, batch_id)
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("injected failure after the batch was written")

    def run(fn):
        s = spark.readStream.schema("n BIGINT").option("maxFilesPerTrigger", 1).parquet(f"{inbox}/*")
        q = s.writeStream.foreachBatch(fn).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()

    with pytest.raises(Exception):
        run(flaky)
    run(writer)
    log = read_log(spark, path)
    got = [(r["part"], r["off"], int(r["data"])) for r in log.collect()]
    assert sorted(v for _, _, v in got) == list(range(100))          # each record once
    for p in range(3):                                                # offsets 0..n-1, in arrival order
        vals = sorted((o, v) for q, o, v in got if q == p)
        assert [o for o, _ in vals] == list(range(len(vals)))
        assert [v for _, v in vals] == sorted(v for _, v in vals)


def test_stream_fails_on_undecodable_message_when_asked(spark):
    from tidelog.options import LogSourceOptions
    from tidelog.schema import LOG_DDL

    path = scratch_dir(spark, "fail-log")
    rows_ = [(0, 0, None, None, '{"k": 1}', None, None), (0, 1, None, None, "not json", None, None)]
    write_log(spark.createDataFrame(rows_, LOG_DDL), path)
    strict = LogSourceOptions("subscriptions/s", FlowControl(10_000, 10),
                              decoder=dec.data_only(dec.json_field("k")), on_error="fail")
    with pytest.raises(Exception, match="cannot decode message"):
        st.run_to_files(st.open_log_stream(spark, path, strict), scratch_dir(spark, "fail-out"),
                        scratch_dir(spark, "fail-ck"))
    lenient = LogSourceOptions("subscriptions/s", FlowControl(10_000, 10), decoder=dec.data_only(dec.json_field("k")))
    out = scratch_dir(spark, "ok-out")
    st.run_to_files(st.open_log_stream(spark, path, lenient), out, scratch_dir(spark, "ok-ck"))
    got = sorted((r["off"], r["value"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1), (1, None)]


def test_round_robin_goes_on_from_batch_to_batch(spark):
    from tidelog.options import LogSinkOptions
    from tidelog.sources.logs import read_log
    from tidelog.streaming.sink import log_sink_writer

    opts = LogSinkOptions("topics/t", 4, encoder=snk.data_only(lambda d: d["n"].cast("string")))
    path = scratch_dir(spark, "rr-log")
    write = log_sink_writer(path, opts, [F.col("data").cast("bigint")], publish_ms=0, rank_order=["n"])
    batches = [[0], [1], [2], [3, 4, 5]]
    for b, values in enumerate(batches):
        for _ in range(2 if b == 2 else 1):                       # a replayed batch is dealt the same way
            write(spark.createDataFrame([(v,) for v in values], "n BIGINT").coalesce(1), b)
    got = sorted((int(r["data"]), r["part"], r["off"]) for r in read_log(spark, path).collect())
    assert got == [(n, n % 4, n // 4) for n in range(6)]
