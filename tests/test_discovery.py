"""Partition discovery, start offsets, restore checks."""

import pytest
from conftest import rows

from tidelog.sources import scan

SUB = "subscriptions/s"


def _parts(spark, n):
    return spark.range(n).selectExpr("CAST(id AS INT) AS part")


def _cursors(spark, d):
    return spark.createDataFrame(list(d.items()), "part INT, off BIGINT")


def test_first_discovery_uses_cursor_or_zero(spark):
    known = spark.createDataFrame([], "part INT")
    out = scan.discover(_parts(spark, 2), known, _cursors(spark, {1: 2}), SUB)
    assert rows(out, "part", "start_off") == [(0, 0), (1, 2)]
    assert {r["subscription"] for r in out.collect()} == {SUB}


def test_incremental_discovery_counts(spark):
    known = spark.createDataFrame([], "part INT")
    got = []
    for n in (2, 3, 3):
        new = scan.discover(_parts(spark, n), known, _cursors(spark, {}), SUB)
        got.append(new.count())
        known = known.unionByName(new.select("part"))
    assert got == [2, 1, 0]


def test_shrink_then_grow_does_not_rediscover(spark):
    known = _parts(spark, 3)
    assert scan.discover(_parts(spark, 2), known, _cursors(spark, {}), SUB).count() == 0
    out = scan.discover(_parts(spark, 4), known, _cursors(spark, {}), SUB)
    assert rows(out, "part") == [(3,)]


def test_topic_partitions_from_log(spark):
    log = spark.createDataFrame([(0, 0), (3, 9)], "part INT, off BIGINT")
    assert rows(scan.topic_partitions(log)) == [(0,), (1,), (2,), (3,)]


def _splits(spark, items):
    return spark.createDataFrame(items, "subscription STRING, part INT, start_off BIGINT")


def test_restore_ok(spark):
    s = _splits(spark, [(SUB, p, 4) for p in range(3)])
    assert scan.restore_violations(s, SUB).count() == 0
    scan.check_restore(s, SUB)
    # restored partitions are known: a topic of 4 partitions yields one new split
    out = scan.discover(_parts(spark, 4), s.select("part"), _cursors(spark, {}), SUB)
    assert rows(out, "part") == [(3,)]


def test_restore_foreign_subscription(spark):
    s = _splits(spark, [(SUB, 0, 0), ("subscriptions/other", 1, 0)])
    assert rows(scan.restore_violations(s, SUB)) == [("foreign_subscription", 1)]
    with pytest.raises(ValueError, match="foreign_subscription"):
        scan.check_restore(s, SUB)


def test_restore_not_continuous(spark):
    s = _splits(spark, [(SUB, 1, 0)])
    assert rows(scan.restore_violations(s, SUB)) == [("missing_partition", 0)]


def test_restore_empty_is_fine(spark):
    assert scan.restore_violations(_splits(spark, []), SUB).count() == 0


def test_scan_from_and_between(spark):
    log = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, 3), (1, 5), (1, 7)], "part INT, off BIGINT")
    starts = spark.createDataFrame([(0, 2), (1, 3)], "part INT, start_off BIGINT")
    assert rows(scan.scan_from(log, starts)) == [(0, 2), (1, 3), (1, 5), (1, 7)]
    assert rows(scan.scan_from(log, starts, inclusive=False)) == [(1, 5), (1, 7)]
    stops = spark.createDataFrame([(1, 7)], "part INT, stop_off BIGINT")
    assert rows(scan.scan_between(log, starts, stops)) == [(0, 2), (1, 3), (1, 5)]


def test_partitions_from_folder_layout(spark):
    from tidelog.schema import LOG_DDL
    from tidelog.session import scratch_dir
    from tidelog.sources.logs import write_log

    path = scratch_dir(spark, "folder-parts")
    write_log(spark.createDataFrame([(0, 1, None, None, "a", None, None), (3, 2, None, None, "b", None, None)],
                                    LOG_DDL), path)
    assert rows(scan.topic_partitions_in_folder(spark, path)) == [(0,), (1,), (2,), (3,)]


def test_partitions_from_nested_layout_fall_back_to_footers(spark):
    from tidelog.schema import LOG_DDL
    from tidelog.session import scratch_dir
    from tidelog.sources.logs import write_log

    path = scratch_dir(spark, "nested-parts")
    write_log(spark.createDataFrame([(2, 1, None, None, "a", None, None)], LOG_DDL), f"{path}/batch=0")
    assert rows(scan.topic_partitions_in_folder(spark, path)) == [(0,), (1,), (2,)]


def test_seek_rejects_two_starts_for_one_partition(spark):
    log = spark.createDataFrame([(0, 0), (0, 2)], "part INT, off BIGINT")
    starts = spark.createDataFrame([(0, 0), (0, 2)], "part INT, start_off BIGINT")
    for bound in (8, None):
        with pytest.raises(Exception, match="one start offset per partition"):
            scan.scan_from(log, starts, part_bound=bound).collect()
        with pytest.raises(Exception, match="one start offset per partition"):
            scan.scan_between(log, starts, starts.withColumnRenamed("start_off", "stop_off"), part_bound=bound).collect()


def test_cursors_of_one_subscription_only(spark):
    cursors = spark.createDataFrame([("fast", 0, 90), ("slow", 0, 10), ("slow", 0, 7)], "subscription STRING, part INT, off BIGINT")
    assert rows(scan.cursors_of(cursors, "slow")) == [(0, 10)]
    assert rows(scan.cursors_of(cursors, "none")) == []


def test_partitions_without_messages_are_discovered(spark):
    known = spark.createDataFrame([(0,), (1,)], "part INT")
    none = spark.createDataFrame([], "part INT, off BIGINT")
    assert rows(scan.discover(scan.topic_partitions_of(spark, 4), known, none, "s")) == [("s", 2, 0), ("s", 3, 0)]
