"""Streaming forms of the reading queries (run to completion with ``availableNow``).

Each query streams the events table through the same operators as its batch counterpart, writes
to the shared checkpoint folder and returns the written result, so it is checked against the
same SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import timestamps as tsf
from tidelog.operators import progress as pg
from tidelog.operators.records import emitted, to_records
from tidelog.plans import log_queries as lq
from tidelog.operators.commits import trace_events
from tidelog.plans.params import CURSOR_AS_OF, EPOCH
from tidelog.plans.registry import REGISTRY, register
from tidelog.session import scratch_dir
from tidelog.sources import scan
from tidelog.options import FlowControl, LogSourceOptions
from tidelog.sources.logs import EVENTS_PARTITIONS, events_log, events_log_from, read_log_between, write_log
from tidelog.streaming import stream as st
from tidelog.streaming.commits_state import run_commit_stream
from tidelog.streaming.dedup import start_redelivery_filter


def _sql(name: str) -> str:
    return REGISTRY[name][1]


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log_from(st.table_stream(spark, sf_dir, "events"))


@register("stream_scan", _sql("scan_from_cursor"))
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming scan from committed cursors."""
    starts = lq._starts(events_log(spark, sf_dir))
    s = scan.scan_from(_events_stream(spark, sf_dir), starts, part_bound=EVENTS_PARTITIONS).select("part", "off")
    out = scratch_dir(spark, "stream-scan")
    st.run_to_files(s, out, scratch_dir(spark, "stream-scan-ck"))
    return spark.read.parquet(out).select("part", "off")


@register("stream_emitted", _sql("emitted"))
def stream_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded, time-stamped values emitted by a stream; undecodable messages skipped."""
    e = emitted(to_records(_events_stream(spark, sf_dir), lq.K, tsf.event_time()))
    out = scratch_dir(spark, "stream-emitted")
    st.run_to_files(e, out, scratch_dir(spark, "stream-emitted-ck"))
    return spark.read.parquet(out).select("part", "off", "value", "ts_ms")


@register("stream_positions", _sql("positions"))
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions maintained by a complete-mode streaming aggregate."""
    r = to_records(_events_stream(spark, sf_dir), lq.K, tsf.event_time())
    p = pg.positions(r)
    out = scratch_dir(spark, "stream-positions")
    st.run_complete(p, out, scratch_dir(spark, "stream-positions-ck"))
    return spark.read.parquet(out).select("part", "position", "n")


@register("stream_commit", f"{lq.W} SELECT part, max(off) AS position FROM log GROUP BY part")
def stream_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors committed after each batch's data is written (skipped messages advance them)."""
    r = to_records(_events_stream(spark, sf_dir), lq.K, tsf.event_time())
    data, cur = scratch_dir(spark, "stream-commit-data"), scratch_dir(spark, "stream-commit-cursors")
    q = st.start_with_cursors(r, data, cur, scratch_dir(spark, "stream-commit-ck"), emit=emitted)
    q.awaitTermination()
    st._raise(q)
    return st.committed_cursors(spark, cur)


@register("stream_restart", f"{lq.W} SELECT part, off FROM log")
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint: data published before a cut, then all other data (rows without a
    publish time included); each row once."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    inbox = scratch_dir(spark, "stream-restart-inbox")
    cut = F.coalesce(F.col("ts") < F.lit(CURSOR_AS_OF).cast("timestamp_ntz"), F.lit(False))
    ck, out = scratch_dir(spark, "stream-restart-ck"), scratch_dir(spark, "stream-restart-out")

    def run() -> None:
        s = events_log_from(spark.readStream.schema(ev.schema).parquet(f"{inbox}/*")).select("part", "off")
        st.run_to_files(s, out, ck)

    ev.where(cut).write.parquet(f"{inbox}/a")
    run()
    ev.where(~cut).write.parquet(f"{inbox}/b")
    run()
    return spark.read.parquet(out).select("part", "off")


def _filtered(spark: SparkSession, deliveries: list[DataFrame], name: str) -> DataFrame:
    """What the redelivery filter passes on when ``deliveries`` land one after the other, each read by a
    run of its own on the same checkpoint."""
    inbox, out, state = scratch_dir(spark, f"{name}-inbox"), scratch_dir(spark, f"{name}-out"), scratch_dir(spark, f"{name}-state")
    ck = scratch_dir(spark, f"{name}-ck")
    for i, rows in enumerate(deliveries):
        rows.write.parquet(f"{inbox}/{i}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{inbox}/*")
        q = start_redelivery_filter(stream, out, state, ck)
        q.awaitTermination()
        st._raise(q)
    return spark.read.parquet(out).select("part", "off")


@register("stream_dedup", _sql("dedup_redelivered"))
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run up to a crash and a resumed run (re-reading from committed cursors) arrive one after
    the other; rows that were passed on before are dropped."""
    log, consumed, committed = lq._crash(spark, sf_dir)
    second = pg.resume_scan(log, committed, inclusive=True, part_bound=EVENTS_PARTITIONS)
    return _filtered(spark, [consumed, second], "stream-dedup")


@register("stream_dedup_lagging", f"{lq.W} SELECT DISTINCT part, off FROM log")
def stream_dedup_lagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four deliveries with redeliveries between them; one partition arrives only in the last one, older
    than everything delivered before.  Every message comes out once."""
    log = events_log(spark, sf_dir)
    consumed, rest = lq._crash(spark, sf_dir)[1], log.where("part <> 1")
    early = consumed.where("part <> 1")
    return _filtered(spark, [early, early, rest, log], "stream-lagging")


@register("stream_dedup_unordered", f"{lq.W} SELECT DISTINCT part, off FROM log")
def stream_dedup_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries out of offset order: the later half, the earlier half with an overlap, days from the middle,
    everything again.  Every message comes out once, also those below offsets that were delivered before."""
    log = events_log(spark, sf_dir)
    late = F.col("publish_time") >= F.lit(CURSOR_AS_OF).cast("timestamp_ntz")
    middle = F.dayofmonth("publish_time").between(8, 20)
    return _filtered(spark, [log.where(late), log.where(~late | middle), log.where(middle), log], "stream-unordered")


# ------------------------------------------------- a written log, read through the file source

def _written_log(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The events log written as a log folder, and its start offsets."""
    log = events_log(spark, sf_dir)
    path = scratch_dir(spark, "written-log")
    write_log(log, path)
    return path, lq._starts(log)


@register("plog_scan", _sql("scan_from_cursor"))
def plog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch seek on a written log: every band of start offsets prunes its own partition folders and row
    groups."""
    path, starts = _written_log(spark, sf_dir)
    return read_log_between(spark, path, starts).select("part", "off")


@register("plog_stream", _sql("scan_from_cursor"))
def plog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written log as a file-source stream from the committed cursors, a byte cap for each trigger."""
    path, starts = _written_log(spark, sf_dir)
    stream = scan.scan_from(st.log_stream(spark, path, FlowControl(1 << 20, 1 << 20)), starts).select("part", "off")
    out = scratch_dir(spark, "plog-stream-out")
    st.run_to_files(stream, out, scratch_dir(spark, "plog-stream-ck"))
    return spark.read.parquet(out).select("part", "off")


@register("stream_effective_commits", _sql("effective_commits"))
def stream_effective_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint trace arrives as a stream in three deliveries; every reader's open checkpoints are keyed
    state that is carried from run to run."""
    cks, notes = lq.order_trace(spark, sf_dir)
    events = trace_events(cks, notes)
    events = events.select("reader", "ck", tsf.epoch_ms(F.col("at")).alias("at"), "kind", F.col("tie.a").alias("tie_a"), F.col("tie.b").alias("tie_b"))
    inbox, out, ck = scratch_dir(spark, "trace-inbox"), scratch_dir(spark, "commits-out"), scratch_dir(spark, "commits-ck")
    day = F.floor((F.col("at") - tsf.epoch_ms(F.lit(EPOCH).cast("timestamp_ntz"))) / 86_400_000)
    for i, some in enumerate((day < 10, (day >= 10) & (day < 20), day >= 20)):
        events.where(some).write.parquet(f"{inbox}/{i}")
        run_commit_stream(spark.readStream.schema(spark.read.parquet(f"{inbox}/{i}").schema).parquet(f"{inbox}/*"), out, ck)
    return spark.read.parquet(out).select("reader", "ck", tsf.from_epoch_ms(F.col("notified_at")).alias("notified_at"), "note", "effective",
                                          tsf.from_epoch_ms(F.col("added_at")).alias("added_at"))


@register("stream_two_subscriptions", f"""{lq.W},
slow AS (SELECT part, max(off) AS position FROM log WHERE publish_time < TIMESTAMP '{CURSOR_AS_OF}' GROUP BY part),
fast AS (SELECT part, max(off) AS position FROM log GROUP BY part)
SELECT 'slow' AS subscription, l.part, l.off FROM log l LEFT JOIN slow USING (part) WHERE position IS NULL OR l.off >= position
UNION ALL SELECT 'fast', l.part, l.off FROM log l JOIN fast USING (part) WHERE l.off >= position""")
def stream_two_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subscriptions commit their cursors to one folder, one of them stops early; a stream under the
    options of each resumes from its own cursors."""
    path, log = scratch_dir(spark, "two-log"), events_log(spark, sf_dir)
    write_log(log, path)
    cursors, found = scratch_dir(spark, "two-cursors"), None
    early = F.col("publish_time") < F.lit(CURSOR_AS_OF).cast("timestamp_ntz")
    for name, rows in (("fast", st.log_stream(spark, path)), ("slow", st.log_stream(spark, path).where(early))):
        q = st.start_with_cursors(rows.select("part", "off"), scratch_dir(spark, f"two-{name}"), cursors, scratch_dir(spark, f"two-{name}-ck"), subscription=name)
        q.awaitTermination()
        st._raise(q)
    for name in ("fast", "slow"):
        options = LogSourceOptions(name, FlowControl(1 << 30, 1 << 30), resume="inclusive")
        out = scratch_dir(spark, f"two-{name}-again")
        st.run_to_files(st.open_log_stream(spark, path, options, cursors), out, scratch_dir(spark, f"two-{name}-again-ck"))
        again = spark.read.parquet(out).select(F.lit(name).alias("subscription"), "part", "off")
        found = again if found is None else found.unionByName(again)
    return found
