"""Decode, timestamps, records, emission, fetch batches - the reader scenarios."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.functions import decode as dec
from tidelog.functions import timestamps as tsf
from tidelog.operators import progress as pg
from tidelog.operators.records import emitted, fetch_batches, flatten_batches, to_records

T0 = dt.datetime(1970, 1, 1)


def _log(spark, items):
    """items: (part, off, data, publish_time, event_time)"""
    return spark.createDataFrame(items, "part INT, off BIGINT, data STRING, publish_time TIMESTAMP_NTZ, "
                                        "event_time TIMESTAMP_NTZ")


def _int_log(spark):
    # part 0: offsets 0, 2; part 1: 1, 3, 5, 7; payload = decimal text of the offset
    items = [(0, o, str(o), T0, None) for o in (0, 2)] + [(1, o, str(o), T0, None) for o in (1, 3, 5, 7)]
    return _log(spark, items)


INT = dec.data_only(lambda d: d.try_cast("bigint"))


def test_emit_all_with_sparse_offsets(spark):
    out = emitted(to_records(_int_log(spark), INT))
    assert rows(out, "value") == [(v,) for v in (0, 1, 2, 3, 5, 7)]


def test_positions_after_first_four(spark):
    recs = to_records(_int_log(spark), INT)
    first4 = recs.where(F.col("value") <= 3)
    assert rows(pg.positions(first4), "part", "position") == [(0, 2), (1, 3)]


def test_positions_default_to_split_start(spark):
    recs = to_records(_int_log(spark), INT).where("part = 0")
    splits = spark.createDataFrame([(0, 0), (1, 4)], "part INT, start_off BIGINT")
    assert rows(pg.positions(recs, splits)) == [(0, 2, 2), (1, 4, 0)]


def test_null_decode_skips_but_advances(spark):
    log = _log(spark, [(1, 10, "one", T0, None), (1, 11, None, T0, None), (2, 20, "two", T0, None)])
    recs = to_records(log, dec.data_only(dec.utf8_text()))
    assert rows(emitted(recs), "value") == [("one",), ("two",)]
    assert rows(pg.positions(recs), "part", "position") == [(1, 11), (2, 20)]
    s = pg.progress_summary(recs)
    assert rows(s) == [(1, 1, 1, 11), (2, 1, 0, 20)]


def test_decode_failure_fails_the_job(spark):
    log = _log(spark, [(0, 1, '{"k": 1}', T0, None), (0, 2, "not json", T0, None)])
    with pytest.raises(Exception, match="cannot decode message at part 0 offset 2"):
        to_records(log, dec.data_only(dec.json_field("k")), on_error="fail").collect()
    # the same input with the skip policy keeps going
    assert to_records(log, dec.data_only(dec.json_field("k"))).where("value IS NULL").count() == 1


def test_timestamp_extractors_truncate_to_millis(spark):
    pt = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    et = dt.datetime(2024, 1, 1, 0, 0, 1, 999999)
    log = _log(spark, [(0, 1, "a", pt, et), (0, 2, "b", pt, None)])
    pub = rows(to_records(log, dec.data_only(dec.utf8_text()), tsf.publish_time()), "off", "ts")
    assert pub == [(1, dt.datetime(2024, 1, 1, 0, 0, 7, 179000)), (2, dt.datetime(2024, 1, 1, 0, 0, 7, 179000))]
    ev = rows(to_records(log, dec.data_only(dec.utf8_text()), tsf.event_time()), "off", "ts")
    assert ev == [(1, dt.datetime(2024, 1, 1, 0, 0, 1, 999000)), (2, dt.datetime(2024, 1, 1, 0, 0, 7, 179000))]


def test_record_time_computed_even_when_value_is_null(spark):
    log = _log(spark, [(0, 10, None, dt.datetime(1970, 1, 1, 0, 0, 0, 1000), None)])
    r = to_records(log, dec.data_only(dec.utf8_text())).first()
    assert r["value"] is None and r["ts"] == dt.datetime(1970, 1, 1, 0, 0, 0, 1000)


def test_two_good_messages_with_ms_timestamps(spark):
    log = _log(spark, [(1, 10, "one", dt.datetime(1970, 1, 1, 0, 0, 0, 1000), None),
                       (2, 20, "two", dt.datetime(1970, 1, 1, 0, 0, 0, 2000), None)])
    out = emitted(to_records(log, dec.data_only(dec.utf8_text())))
    assert rows(out, "value", "ts_ms") == [("one", 1), ("two", 2)]


def test_fetch_batches_nested_and_flattened(spark):
    items = [(0, o, str(o), T0, None) for o in (2, 4, 6)] + [(1, o, str(o), T0, None) for o in (1, 3, 5)]
    recs = to_records(_log(spark, items), INT)
    b = fetch_batches(recs, fetch_size=4)
    # no batch holds more than fetch_size offsets of a partition
    assert max(len(r["records"]) for r in b.collect()) <= 4
    flat = flatten_batches(b)
    assert rows(flat, "part", "value") == [(0, 2), (0, 4), (0, 6), (1, 1), (1, 3), (1, 5)]


def test_pandas_decoder(spark):
    import pandas as pd

    def codec(s: pd.Series) -> pd.Series:
        return s.str.upper()
    log = _log(spark, [(0, 1, "ab", T0, None)])
    out = to_records(log, dec.data_only(dec.pandas_decoder(codec, "string")))
    assert out.first()["value"] == "AB"


def test_positions_over_all_partitions_fill_gaps(spark):
    recs = spark.createDataFrame([(1, 5, "a"), (1, 7, None), (3, 2, "b")], "part INT, off BIGINT, value STRING")
    assert rows(pg.positions(recs, all_partitions=True)) == [(0, 0, 0), (1, 7, 2), (2, 0, 0), (3, 2, 1)]
