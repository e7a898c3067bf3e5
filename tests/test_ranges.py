"""Redelivery filter by offset ranges, the store behind it, and cursors of several subscriptions."""

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.options import FlowControl, LogSourceOptions
from tidelog.session import scratch_dir
from tidelog.sources.logs import write_log
from tidelog.schema import LOG_DDL
from tidelog.streaming import dedup, stream as st
from tidelog.streaming.store import BatchStore


def _filter(spark, batches, width, every=2, replay=()):
    out, state = scratch_dir(spark, "ranges-out"), scratch_dir(spark, "ranges-state")
    write = dedup.range_filter(out, state, width, every)
    for b, offs in enumerate(batches):
        df = spark.createDataFrame(offs, "part INT, off BIGINT")
        for _ in range(2 if b in replay else 1):
            write(df, b)
    return spark.read.parquet(out), BatchStore(spark, state, ["part", "chunk"], every)


def test_later_batch_of_lower_offsets_is_not_lost(spark):
    got, store = _filter(spark, [[(0, o) for o in range(10, 20)], [(0, o) for o in range(10)]], 1 << 16)
    assert rows(got, "off") == [(o,) for o in range(20)]
    assert rows(store.read(), "part", "lo", "hi") == [(0, 0, 19)]


def test_any_order_equals_distinct_and_state_follows_gaps(spark):
    rnd = random.Random(4)
    for trial in range(3):
        sent = [(p, o) for p in range(3) for o in range(120) if p or o % 7]
        batches = [rnd.sample(sent, rnd.randint(1, 200)) + rnd.choices(sent, k=20) for _ in range(4)] + [sent]
        got, store = _filter(spark, batches, 16, replay=(1, 2))
        assert rows(got, "part", "off") == sorted(sent), trial
        ranges = rows(store.read(), "part", "chunk", "lo", "hi")
        assert [r for r in ranges if r[0] == 1] == [(1, c, 16 * c, min(16 * c + 15, 119)) for c in range(8)]
        assert all(lo // 16 == hi // 16 == c for _, c, lo, hi in ranges)


def test_store_reads_last_batch_of_each_key_and_ignores_unfinished_snapshots(spark):
    path = scratch_dir(spark, "store")
    store = BatchStore(spark, path, ["k"], every=3)
    assert store.read() is None
    for b in range(7):
        store.write(spark.createDataFrame([(b % 4, b * 10), (9, b)], "k INT, v INT"), b)
    want = [(0, 40), (1, 50), (2, 60), (3, 30), (9, 6)]
    assert rows(store.read()) == want
    assert rows(store.read(before=5)) == [(0, 40), (1, 10), (2, 20), (3, 30), (9, 4)]
    # a restart in the middle of writing a snapshot: no marker yet, so it does not count
    os.remove(os.path.join(path, "snapshot", "batch=5", "_SUCCESS"))
    assert rows(store.read()) == want
    # replay of the batch writes both again
    store.write(spark.createDataFrame([(1, 50), (9, 5)], "k INT, v INT"), 5)
    assert rows(store.read()) == want and os.path.exists(os.path.join(path, "snapshot", "batch=5", "_SUCCESS"))


def _log(spark, n=25):
    path = scratch_dir(spark, "subs-log")
    write_log(spark.createDataFrame([(p, o, None, None, str(o), None, None) for p in range(2) for o in range(n)], LOG_DDL), path)
    return path


def test_each_subscription_resumes_from_its_own_cursors(spark):
    path = _log(spark)
    table = spark.createDataFrame([("a", 0, 10), ("b", 0, 3), ("b", 1, 20)], "subscription STRING, part INT, position BIGINT")
    for name, want in (("a", [(0, o) for o in range(11, 25)] + [(1, o) for o in range(25)]),
                       ("b", [(0, o) for o in range(4, 25)] + [(1, o) for o in range(21, 25)])):
        out = scratch_dir(spark, "subs-out")
        s = st.open_log_stream(spark, path, LogSourceOptions(name, FlowControl(10_000, 10)), table)
        st.run_to_files(s, out, scratch_dir(spark, "subs-ck"))
        assert rows(spark.read.parquet(out), "part", "off") == want


def test_partition_with_two_cursors_fails_the_stream(spark):
    twice = spark.createDataFrame([(0, 10), (0, 3)], "part INT, position BIGINT")
    s = st.open_log_stream(spark, _log(spark), LogSourceOptions("a", FlowControl(10_000, 10)), twice)
    with pytest.raises(Exception, match="repeated: 0"):
        st.run_to_files(s, scratch_dir(spark, "twice-out"), scratch_dir(spark, "twice-ck"))


def test_cursor_folder_keeps_subscriptions_apart(spark):
    path, cursors = _log(spark), scratch_dir(spark, "subs-cursors")
    for name, below in (("subscriptions/x/y", 25), ("subscriptions/x", 8)):
        rows_ = st.log_stream(spark, path).where(F.col("off") < below)
        st.start_with_cursors(rows_, scratch_dir(spark, "d"), cursors, scratch_dir(spark, "c"), subscription=name).awaitTermination()
    assert rows(st.committed_cursors(spark, cursors, "subscriptions/x/y")) == [(0, 24), (1, 24)]
    assert rows(st.committed_cursors(spark, cursors, "subscriptions/x")) == [(0, 7), (1, 7)]
    assert rows(st.committed_cursors(spark, cursors, "none")) == []
