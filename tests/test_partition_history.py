"""A partition count that changes: the count in force, and a sink that follows it from batch to batch."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.functions.routing import partitions_at
from tidelog.operators import sink as snk
from tidelog.options import LogSinkOptions
from tidelog.session import scratch_dir
from tidelog.sources.logs import read_log
from tidelog.streaming.sink import log_sink_writer


def test_count_in_force(spark):
    at = spark.createDataFrame([(t,) for t in (-5, 0, 9, 10, 11, 25, None)], "t BIGINT")
    got = [r[0] for r in at.select(partitions_at(F.col("t"), [(10, 6), (0, 4), (20, 5)])).collect()]
    assert got == [4, 4, 4, 6, 6, 5, 4]
    for bad in ([], [(0, 0)], [(0, 1), (0, 2)]):
        with pytest.raises(ValueError):
            partitions_at(F.col("t"), bad)


def test_sink_reads_the_history_in_every_batch(spark):
    history, path = scratch_dir(spark, "history"), scratch_dir(spark, "followed")
    rec = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), F.col("id").cast("string").alias("value"))
    opts = LogSinkOptions("t", 1)

    def write(batch_id, now, lo, hi):
        log_sink_writer(path, opts, [F.col("data").cast("bigint")], key=F.col("k"), publish_ms=now, history=history)(rec(lo, hi), batch_id)

    spark.createDataFrame([(0, 2)], "from_ms BIGINT, count INT").write.parquet(history)
    write(0, 50, 0, 6)
    spark.createDataFrame([(100, 3)], "from_ms BIGINT, count INT").write.mode("append").parquet(history)
    write(1, 150, 6, 12)
    write(1, 150, 6, 12)        # a replay
    want = [(k % 2, k // 2, str(k)) for k in range(6)] + [(0, 3, "6"), (1, 3, "7"), (2, 0, "8"), (0, 4, "9"), (1, 4, "10"), (2, 1, "11")]
    assert rows(read_log(spark, path), "part", "off", "data") == sorted(want)


def test_round_robin_under_a_count_per_record(spark):
    df = spark.range(6).select("id", F.when(F.col("id") < 3, 2).otherwise(3).alias("n"))
    env = snk.envelope(df, snk.data_only(lambda d: d["id"].cast("string")), None, None, 0, F.col("n"), rank=F.col("id"))
    assert rows(env, "data", "part") == [("0", 0), ("1", 1), ("2", 0), ("3", 0), ("4", 1), ("5", 2)]
