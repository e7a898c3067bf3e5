"""Operators on empty inputs return empty results instead of failing."""

from pyspark.sql import functions as F

from tidelog.functions import decode as dec
from tidelog.operators import assign as asg
from tidelog.operators import progress as pg
from tidelog.operators.ordered import index_within, prev_offset
from tidelog.operators.records import emitted, fetch_batches, flatten_batches, to_records
from tidelog.schema import LOG_DDL
from tidelog.sources import scan


def test_empty_log_everywhere(spark):
    log = spark.createDataFrame([], LOG_DDL)
    recs = to_records(log, dec.data_only(dec.utf8_text()))
    assert emitted(recs).count() == 0
    assert pg.positions(recs).count() == 0
    assert pg.positions(recs, all_partitions=True).count() == 0
    assert scan.topic_partitions(log).count() == 0
    starts = scan.start_offsets(scan.topic_partitions(log), scan.cursors_as_of(log, "2024-01-01"), part_bound=8)
    assert starts.count() == 0
    assert scan.scan_from(log, starts, part_bound=8).count() == 0
    assert pg.checkpoint_snapshots(log, F.lit(0), 2).count() == 0
    assert pg.checkpoint_barriers(log, F.lit(0), 2).count() == 0
    assert prev_offset(log.select("part", "off")).count() == 0
    assert index_within(log, ["part"], ["off"], out="i").count() == 0
    assert flatten_batches(fetch_batches(recs)).count() == 0


def test_empty_assignment_and_commits(spark):
    keys = spark.createDataFrame([], "key BIGINT")
    assert asg.assign_least_loaded(keys, ["key"], 3).count() == 0
    cks = spark.createDataFrame([], "reader INT, ck BIGINT, added_at BIGINT, seq BIGINT")
    notes = spark.createDataFrame([], "reader INT, ck BIGINT, notified_at BIGINT")
    assert pg.effective_commits(cks, notes).count() == 0
