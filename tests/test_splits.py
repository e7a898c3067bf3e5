"""Split ids, split state round trip and duplicate-add handling."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.functions.splits import dedup_splits, split_from_state, split_id, split_to_state

PATH = "projects/p/locations/l/subscriptions/s"


def test_split_id_format(spark):
    df = spark.createDataFrame([(PATH, 1, 2)], "subscription STRING, part INT, start_off BIGINT")
    assert df.select(split_id().alias("id")).first()["id"] == f"1-2-{PATH}"


def test_state_roundtrip_both_ways(spark):
    df = spark.createDataFrame([(PATH, 0, 0), (PATH, 7, 123456789012)], "subscription STRING, part INT, start_off BIGINT")
    back = split_from_state(split_to_state(df).select("state"))
    assert rows(back) == rows(df)
    again = split_to_state(back).select("state")
    assert rows(again) == rows(split_to_state(df).select("state"))


def test_state_unknown_version_fails(spark):
    bad = spark.createDataFrame([('{"v":1,"subscription":"s","part":0,"start_off":0}',)], "state STRING")
    with pytest.raises(Exception, match="unknown split state version"):
        split_from_state(bad).collect()


def test_duplicate_add_counts_once_but_new_offset_is_new_split(spark):
    df = spark.createDataFrame([(PATH, 0, 5), (PATH, 0, 5), (PATH, 1, 3), (PATH, 0, 6)],
                               "subscription STRING, part INT, start_off BIGINT")
    out = dedup_splits(df)
    assert rows(out, "part", "start_off") == [(0, 5), (0, 6), (1, 3)]
    assert out.where(F.col("split_id") == f"0-5-{PATH}").count() == 1


def test_enumerator_state_roundtrip_keeps_missing_task(spark):
    from tidelog.functions.splits import enumerator_from_state, enumerator_to_state
    from tidelog.sources import scan

    a = spark.createDataFrame([(PATH, 0, 5, 1), (PATH, 1, 0, None)], "subscription STRING, part INT, start_off BIGINT, task INT")
    back = enumerator_from_state(enumerator_to_state(a, PATH, "topics/t"))
    assert rows(back) == [(PATH, "topics/t", 0, 5, 1), (PATH, "topics/t", 1, 0, None)]
    # the restored topic is checked against the live one
    assert rows(scan.restore_violations(back, PATH, topic="topics/other")) == [
        ("topic_mismatch", 0), ("topic_mismatch", 1)]
    assert scan.restore_violations(back, PATH, topic="topics/t").count() == 0
