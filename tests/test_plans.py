"""Physical-plan properties the scale design relies on."""

import contextlib
import io

from pyspark.sql import functions as F

from tidelog.operators import progress as pg
from tidelog.operators.ordered import prev_offset
from tidelog.session import scratch_dir
from tidelog.sources import scan
from tidelog.sources.logs import events_log, read_log, read_log_between, write_log

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def rows_read(df):
    """Rows that the file scans of a query gave out when it ran."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("numOutputRows").value() if kind == "FileSourceScanExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_seek_prunes_each_partition_by_its_own_start(spark):
    """One lagging partition at 0, the others at 90 %: the others' files below their start are not read."""
    path = scratch_dir(spark, "plan-log")
    log = spark.range(8000).selectExpr(
        "CAST(id % 8 AS INT) AS part", "id DIV 8 AS off", "TIMESTAMP_NTZ '2024-01-01' AS publish_time",
        "CAST(NULL AS TIMESTAMP_NTZ) AS event_time", "'x' AS data", "'a' AS attr", "0.0D AS value")
    log.repartitionByRange(160, "part", "off").sortWithinPartitions("part", "off").write.partitionBy("part").parquet(path)
    starts = spark.createDataFrame([(p, 900 if p else 0) for p in range(8)], "part INT, start_off BIGINT")
    df = read_log_between(spark, path, starts)
    assert df.count() == 1000 + 7 * 100
    assert rows_read(read_log_between(spark, path, starts)) < 3000 < rows_read(scan.scan_from(read_log(spark, path), starts))
    stops = spark.createDataFrame([(0, 10)], "part INT, stop_off BIGINT")
    assert read_log_between(spark, path, starts, stops).count() == 10 + 7 * 100
    only = starts.where("part = 3")
    assert rows_read(read_log_between(spark, path, only)) <= 200


def test_positions_aggregate_partially_before_the_shuffle(spark):
    p = plan(pg.positions(events_log(spark, SF)))
    assert "partial_max(off" in p and "partial_count" in p


def test_prev_offset_shuffles_on_partition_and_chunk(spark):
    p = plan(prev_offset(events_log(spark, SF).select("part", "off"), width=64))
    assert "hashpartitioning(part" in p and "_chunk" in p
    assert "SinglePartition" not in p


def test_snapshot_grid_is_spread_by_partition(spark):
    log = events_log(spark, SF)
    snaps = pg.checkpoint_snapshots(log, F.datediff(F.to_date("publish_time"), F.lit("2024-01-01")), 2)
    p = plan(snaps)
    assert "hashpartitioning(part" in p
    # the only single-partition exchanges feed the one-row bounds aggregate (max part, ck range)
    for section in p.split("\n\n"):
        if "Arguments: SinglePartition" in section:
            assert "Input [3]: [max#" in section and "min#" in section, section


def test_bounded_tables_are_broadcast(spark):
    log = events_log(spark, SF)
    committed = spark.createDataFrame([(0, 5)], "part INT, position BIGINT")
    p = plan(pg.resume_scan(log, committed, part_bound=8))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_assignment_has_no_cartesian_product(spark):
    from tidelog.operators.assign import assign_least_loaded
    keys = spark.range(50).select(F.col("id").alias("key"))
    p = plan(assign_least_loaded(keys, ["key"], 4))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_assignment_with_existing_keys_uses_equi_joins_only(spark):
    from tidelog.operators.assign import assign_least_loaded
    keys = spark.range(60).select(F.col("id").alias("key"))
    existing = spark.range(10).select(F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("task"))
    p = plan(assign_least_loaded(keys, ["key"], 4, existing=existing))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_positions_from_footers_read_no_rows(spark):
    path = scratch_dir(spark, "plan-footers")
    write_log(events_log(spark, SF), path)
    df = pg.positions_from_footers(spark, path)
    p = plan(df)
    assert "PushedAggregation: [MAX(off), COUNT(*)]" in p and "PushedGroupBy: [part]" in p
    want = sorted(tuple(r) for r in pg.positions(read_log(spark, path)).collect())
    assert sorted(tuple(r) for r in df.collect()) == want
