"""Reading side: scans, discovery, decode, timestamps, records, splits, positions, commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import decode as dec
from tidelog.functions import timestamps as tsf
from tidelog.functions.splits import (dedup_splits, enumerator_from_state, enumerator_to_state, split_from_state,
                                     split_id, split_to_state)
from tidelog.operators import progress as pg
from tidelog.operators.ordered import prev_offset
from tidelog.operators.records import emitted, fetch_batches, flatten_batches, to_records
from tidelog.plans.params import (CHECKPOINT_IDS, COMMIT_READERS, CRASH_AT, CURSOR_AS_OF, CURSOR_PARTS, EPOCH,
                                  EVENTS_LOG_SQL, FETCH_SIZE, FINISHED_AT, FINISHED_FROM, FOREIGN_SUBSCRIPTION,
                                  K_SQL, KNOWN_BELOW, LI_CK_DAYS, LI_CURSOR_AS_OF, LI_EPOCH, LINEITEM_LOG_SQL,
                                  READERS, STOP_AS_OF, SUBSCRIPTION, TRACE_EPOCH, TRACE_MINUTES, TRACE_SQL)
from tidelog.plans.registry import register
from tidelog.schema import SPLIT_DDL
from tidelog.sources import scan
from tidelog.sources.logs import EVENTS_PARTITIONS, LINEITEM_PARTITIONS, events_log, lineitem_log, table

K = dec.data_only(dec.json_field("k"))
P = EVENTS_PARTITIONS


def _cursors(log: DataFrame) -> DataFrame:
    return scan.cursors_as_of(log, CURSOR_AS_OF)


def _starts(log: DataFrame) -> DataFrame:
    return scan.start_offsets(scan.topic_partitions(log), _cursors(log), part_bound=P)


def _day(col: str = "publish_time", epoch: str = EPOCH):
    return F.datediff(F.to_date(F.col(col)), F.lit(epoch))


def _event_records(log: DataFrame) -> DataFrame:
    return to_records(log, K, tsf.event_time())


W = "WITH " + EVENTS_LOG_SQL
CUR_SQL = f"cur AS (SELECT part, max(off) AS off FROM log WHERE publish_time < TIMESTAMP '{CURSOR_AS_OF}' GROUP BY part)"
PARTS_SQL = "parts AS (SELECT CAST(range AS INTEGER) AS part FROM range(0, (SELECT max(part) + 1 FROM log)))"
STARTS_SQL = f"{CUR_SQL}, {PARTS_SQL}, starts AS (SELECT p.part, coalesce(c.off, 0) AS start_off FROM parts p LEFT JOIN cur c USING (part))"


# ---------------------------------------------------------------- scans and discovery

@register("scan_from_cursor", f"""{W}, {STARTS_SQL}
SELECT l.part, l.off FROM log l JOIN starts s USING (part) WHERE l.off >= s.start_off""")
def scan_from_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every partition from its committed cursor on (inclusive seek)."""
    log = events_log(spark, sf_dir)
    return scan.scan_from(log, _starts(log), part_bound=P).select("part", "off")


@register("bounded_scan", f"""{W}, {STARTS_SQL},
stops AS (SELECT part, max(off) AS stop_off FROM log WHERE publish_time < TIMESTAMP '{STOP_AS_OF}' GROUP BY part)
SELECT l.part, l.off FROM log l JOIN starts s USING (part) LEFT JOIN stops t USING (part)
WHERE l.off >= s.start_off AND (t.stop_off IS NULL OR l.off < t.stop_off)""")
def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows between the cursor as of one day and the cursor as of a later day."""
    log = events_log(spark, sf_dir)
    stops = scan.cursors_as_of(log, STOP_AS_OF).withColumnRenamed("off", "stop_off")
    return scan.scan_between(log, _starts(log), stops, part_bound=P).select("part", "off")


@register("ordered_scan", f"""{W}
SELECT part, off, lag(off) OVER (PARTITION BY part ORDER BY off) AS prev_off FROM log""")
def ordered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each partition in offset order: every row with the offset read just before it."""
    log = events_log(spark, sf_dir).select("part", "off")
    return prev_offset(log, width=1024).select("part", "off", "prev_off")


@register("ordered_scan_sparse", f"""{W}
SELECT part, off * 2000 AS off, lag(off * 2000) OVER (PARTITION BY part ORDER BY off) AS prev_off FROM log""")
def ordered_scan_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset order on a log with large gaps between its offsets."""
    log = events_log(spark, sf_dir).select("part", (F.col("off") * 2000).alias("off"))
    return prev_offset(log, width=1024).select("part", "off", "prev_off")


@register("start_offsets", f"""{W}, {STARTS_SQL} SELECT part, start_off FROM starts""")
def start_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start offset of every partition: committed cursor, else 0."""
    log = events_log(spark, sf_dir)
    return _starts(log)


_ODD_CUR_SQL = (f"cur AS (SELECT part, max(off) AS off FROM log WHERE publish_time < TIMESTAMP '{CURSOR_AS_OF}' "
                f"AND part IN {CURSOR_PARTS} GROUP BY part)")


@register("discover_initial", f"""{W}, {_ODD_CUR_SQL}, {PARTS_SQL}
SELECT '{SUBSCRIPTION}' AS subscription, p.part, coalesce(c.off, 0) AS start_off FROM parts p LEFT JOIN cur c USING (part)""")
def discover_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First discovery: every partition is new; cursors exist for a few partitions only."""
    log = events_log(spark, sf_dir)
    cursors = _cursors(log).where(F.col("part").isin(*CURSOR_PARTS))
    known = spark.createDataFrame([], "part INT")
    return scan.discover(scan.topic_partitions(log), known, cursors, SUBSCRIPTION, part_bound=P)


@register("discover_incremental", f"""{W}, {_ODD_CUR_SQL}, {PARTS_SQL}
SELECT '{SUBSCRIPTION}' AS subscription, p.part, coalesce(c.off, 0) AS start_off FROM parts p LEFT JOIN cur c USING (part)
WHERE p.part >= {KNOWN_BELOW}""")
def discover_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later discovery: partitions already known are not returned again."""
    log = events_log(spark, sf_dir)
    cursors = _cursors(log).where(F.col("part").isin(*CURSOR_PARTS))
    known = scan.topic_partitions(log).where(F.col("part") < KNOWN_BELOW)
    return scan.discover(scan.topic_partitions(log), known, cursors, SUBSCRIPTION, part_bound=P)


@register("restore_violations", f"""{W}, {STARTS_SQL},
restored AS (
  SELECT '{SUBSCRIPTION}' AS subscription, part, start_off FROM starts WHERE part <> 2
  UNION ALL SELECT '{FOREIGN_SUBSCRIPTION}', 3, 0),
present AS (SELECT DISTINCT part FROM restored)
SELECT 'foreign_subscription' AS kind, part FROM restored WHERE subscription <> '{SUBSCRIPTION}'
UNION ALL
SELECT 'missing_partition' AS kind, CAST(range AS INTEGER) AS part FROM range(0, (SELECT count(*) FROM present))
WHERE CAST(range AS INTEGER) NOT IN (SELECT part FROM present)""")
def restore_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restore checks on a split set with partition 2 lost and one split of another subscription."""
    log = events_log(spark, sf_dir)
    splits = (_starts(log).where(F.col("part") != 2)
              .select(F.lit(SUBSCRIPTION).alias("subscription"), "part", "start_off"))
    foreign = spark.createDataFrame([(FOREIGN_SUBSCRIPTION, 3, 0)], SPLIT_DDL)
    return scan.restore_violations(splits.unionByName(foreign), SUBSCRIPTION)


# ---------------------------------------------------------------- decode and timestamps

@register("decode_data_only", f"{W} SELECT part, off, {K_SQL} AS k FROM log")
def decode_data_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload-only decode: ``k`` of the JSON payload, null when undecodable."""
    return dec.decode(events_log(spark, sf_dir), K, out="k").select("part", "off", "k")


@register("decode_full_message", f"""{W}
SELECT part, off, CASE WHEN ({K_SQL}) IS NOT NULL THEN attr || ':' || CAST({K_SQL} AS VARCHAR) END AS label FROM log""")
def decode_full_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-message decode: the decoder reads the payload and the ``attr`` field."""
    def decoder(df: DataFrame):
        k = dec.json_field("k")(df["data"])
        return F.when(k.isNotNull(), F.concat(df["attr"], F.lit(":"), k.cast("string")))
    return dec.decode(events_log(spark, sf_dir), dec.full_message(decoder), out="label").select("part", "off", "label")


@register("decode_skip_progress", f"""{W}
SELECT part, CAST(count({K_SQL}) AS BIGINT) AS emitted, CAST(count(*) - count({K_SQL}) AS BIGINT) AS skipped,
       max(off) AS position FROM log GROUP BY part""")
def decode_skip_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecodable messages are skipped but still advance the position."""
    return pg.progress_summary(_event_records(events_log(spark, sf_dir)))


@register("ts_publish", f"{W} SELECT part, off, date_trunc('millisecond', publish_time) AS ts FROM log")
def ts_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record time = publish time, in milliseconds."""
    log = events_log(spark, sf_dir)
    return log.select("part", "off", tsf.publish_time()(log).alias("ts"))


@register("ts_event_fallback", f"""{W}
SELECT part, off, date_trunc('millisecond', coalesce(event_time, publish_time)) AS ts FROM log""")
def ts_event_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record time = event time, falling back to publish time."""
    log = events_log(spark, sf_dir)
    return log.select("part", "off", tsf.event_time()(log).alias("ts"))


@register("ts_custom", f"""{W}
SELECT part, off, make_timestamp(epoch_ms(date_trunc('millisecond', publish_time)) * 1000 + coalesce({K_SQL}, 0) * 1000) AS ts FROM log""")
def ts_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user extractor: publish time shifted by the payload's ``k`` milliseconds."""
    log = events_log(spark, sf_dir)

    def fn(df: DataFrame):
        k = F.coalesce(dec.json_field("k")(df["data"]), F.lit(0))
        return tsf.from_epoch_ms(tsf.epoch_ms(tsf.ms(df["publish_time"])) + k)
    return log.select("part", "off", tsf.custom(fn)(log).alias("ts"))


# ---------------------------------------------------------------- records

@register("records", f"""{W}
SELECT part, off, {K_SQL} AS value, date_trunc('millisecond', coalesce(event_time, publish_time)) AS ts FROM log""")
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded value and record time for every message (value null when undecodable)."""
    return _event_records(events_log(spark, sf_dir))


@register("emitted", f"""{W}, r AS (SELECT part, off, {K_SQL} AS value,
  epoch_ms(date_trunc('millisecond', coalesce(event_time, publish_time))) AS ts_ms FROM log)
SELECT part, off, value, ts_ms FROM r WHERE value IS NOT NULL""")
def emitted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reaches downstream: decodable values with epoch-millisecond timestamps."""
    return emitted(_event_records(events_log(spark, sf_dir)))


@register("flatten_batches", f"{W} SELECT part, off, {K_SQL} AS value FROM log")
def flatten_batches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records grouped into per-partition fetch batches and flattened back."""
    b = fetch_batches(_event_records(events_log(spark, sf_dir)), FETCH_SIZE)
    return flatten_batches(b).select("part", "off", "value")


@register("split_id", f"""{W}, {STARTS_SQL}
SELECT part, start_off, printf('%d-%d-%s', part, start_off, '{SUBSCRIPTION}') AS split_id FROM starts""")
def split_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split id of every start split."""
    s = _starts(events_log(spark, sf_dir)).withColumn("subscription", F.lit(SUBSCRIPTION))
    return s.select("part", "start_off", split_id().alias("split_id"))


@register("split_state_roundtrip", f"""{W}, {STARTS_SQL}
SELECT '{SUBSCRIPTION}' AS subscription, part, start_off FROM starts""")
def split_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits to versioned JSON state and back, lossless."""
    s = _starts(events_log(spark, sf_dir)).select(F.lit(SUBSCRIPTION).alias("subscription"), "part", "start_off")
    return split_from_state(split_to_state(s).select("state"))


TOPIC = "topics/events"


@register("enumerator_state_roundtrip", f"""{W}, {STARTS_SQL}
SELECT '{SUBSCRIPTION}' AS subscription, '{TOPIC}' AS topic, part, start_off,
       CASE WHEN part = 7 THEN NULL ELSE CAST(part % 3 AS INTEGER) END AS task FROM starts""")
def enumerator_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments (one split unassigned) to versioned enumerator state rows and back."""
    s = (_starts(events_log(spark, sf_dir))
         .select(F.lit(SUBSCRIPTION).alias("subscription"), "part", "start_off",
                 F.when(F.col("part") != 7, (F.col("part") % 3).cast("int")).alias("task")))
    return enumerator_from_state(enumerator_to_state(s, SUBSCRIPTION, TOPIC))


@register("split_dedup", f"""{W}, {STARTS_SQL},
added AS (SELECT part, start_off FROM starts
          UNION ALL SELECT part, start_off FROM starts WHERE part % 2 = 1
          UNION ALL SELECT part, start_off + 1 FROM starts WHERE part = 0)
SELECT DISTINCT printf('%d-%d-%s', part, start_off, '{SUBSCRIPTION}') AS split_id, part, start_off FROM added""")
def split_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits added twice count once; the same partition at another offset is another split."""
    s = _starts(events_log(spark, sf_dir))
    added = (s.unionByName(s.where(F.col("part") % 2 == 1))
             .unionByName(s.where(F.col("part") == 0).withColumn("start_off", F.col("start_off") + 1))
             .withColumn("subscription", F.lit(SUBSCRIPTION)))
    return dedup_splits(added).select("split_id", "part", "start_off")


# ---------------------------------------------------------------- positions and commits

@register("positions", f"{W} SELECT part, max(off) AS position, count(*) AS n FROM log GROUP BY part")
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last consumed offset and messages consumed per partition, skipped messages included."""
    return pg.positions(_event_records(events_log(spark, sf_dir)), part_bound=P, all_partitions=True)


@register("positions_from_footers", f"{W} SELECT part, max(off) AS position, count(*) AS n FROM log GROUP BY part")
def positions_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log written as a log folder; its positions answered from Parquet footers."""
    from tidelog.session import scratch_dir
    from tidelog.sources.logs import write_log

    path = scratch_dir(spark, "footer-log")
    write_log(events_log(spark, sf_dir), path)
    return pg.positions_from_footers(spark, path)


SNAP_SQL = f"""snaps AS (
  SELECT p.part % {READERS} AS reader, d.ck, p.part,
         coalesce(max(x.m) OVER (PARTITION BY p.part ORDER BY d.ck ROWS UNBOUNDED PRECEDING), 0) AS position
  FROM (SELECT CAST(range AS INTEGER) AS part FROM range(0, (SELECT max(part) + 1 FROM log))) p
  CROSS JOIN (SELECT range AS ck FROM range((SELECT min(CAST(CAST(publish_time AS DATE) - DATE '{EPOCH}' AS BIGINT)) FROM log),
                                            (SELECT max(CAST(CAST(publish_time AS DATE) - DATE '{EPOCH}' AS BIGINT)) FROM log) + 1)) d
  LEFT JOIN (SELECT part, CAST(CAST(publish_time AS DATE) - DATE '{EPOCH}' AS BIGINT) AS ck, max(off) AS m FROM log GROUP BY ALL) x
    ON x.part = p.part AND x.ck = d.ck)"""
WR = "WITH RECURSIVE " + EVENTS_LOG_SQL
COMMITTED_SQL = """last AS (SELECT reader, arg_max(added_at, i) AS added_at FROM commits WHERE effective {extra} GROUP BY reader),
committed AS (
  SELECT p.part, coalesce(max(l.off), 0) AS position
  FROM (SELECT DISTINCT part FROM log) p JOIN last ON last.reader = p.part % """ + str(COMMIT_READERS) + """
  LEFT JOIN log l ON l.part = p.part AND l.publish_time <= last.added_at GROUP BY p.part)"""


def _snapshots(log: DataFrame) -> DataFrame:
    return pg.checkpoint_snapshots(log, _day(), READERS)


def order_trace(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Checkpoints and completions, one each for every order: the reader of its customer adds a checkpoint at
    the order date, and is told that it is complete when the order's last item is shipped.  Ids come again."""
    def on_axis(day: str):
        minutes = F.datediff(F.to_date(F.col(day)), F.lit(TRACE_EPOCH)) * F.lit(TRACE_MINUTES)
        return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)

    reader, ck = F.col("o_custkey") % COMMIT_READERS, F.col("o_orderkey") % CHECKPOINT_IDS
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    cks = orders.select(reader.alias("reader"), ck.alias("ck"), on_axis("o_orderdate").alias("added_at"), F.col("o_orderkey").alias("seq"))
    notes = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        reader.alias("reader"), ck.alias("ck"), on_axis("shipped").alias("notified_at"), F.col("o_orderkey").alias("note"))
    return cks, notes


def _reader_parts(log: DataFrame) -> DataFrame:
    """``reader, part, start_off`` of the checkpoint trace."""
    return scan.topic_partitions(log).select((F.col("part") % COMMIT_READERS).cast("bigint").alias("reader"), "part",
                                             F.lit(0).cast("bigint").alias("start_off"))


def _committed(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Cursors after ``commits``: positions at the barriers whose values were committed."""
    barriers = commits.where("effective").select("reader", "ck", "seq", "added_at")
    return pg.committed_cursors(pg.snapshots_at(log, barriers, _reader_parts(log)), commits)


@register("checkpoint_snapshots", f"{W}, {SNAP_SQL} SELECT reader, ck, part, position FROM snaps")
def checkpoint_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every partition at every daily checkpoint barrier."""
    return _snapshots(events_log(spark, sf_dir))


@register("checkpoint_snapshots_sparse", f"""{W},
bars AS (
  SELECT o_custkey % {COMMIT_READERS} AS reader, o_orderkey % {CHECKPOINT_IDS} AS ck, o_orderkey AS seq,
         TIMESTAMP '{EPOCH}' + (CAST(o_orderdate AS DATE) - DATE '{TRACE_EPOCH}') * INTERVAL {TRACE_MINUTES} MINUTE AS added_at FROM orders),
changes AS (
  SELECT part, publish_time AS t, max(off) AS off FROM log
  WHERE part < {FINISHED_FROM} OR publish_time < TIMESTAMP '{FINISHED_AT}' GROUP BY ALL),
r AS (
  SELECT NULL AS reader, NULL AS ck, NULL AS seq, part, t, 0 AS kind, off FROM changes
  UNION ALL SELECT b.reader, b.ck, b.seq, p.part, b.added_at, 1, NULL FROM bars b JOIN (SELECT DISTINCT part FROM log) p ON p.part % {COMMIT_READERS} = b.reader)
SELECT reader, ck, seq, t AS added_at, part, position FROM (
  SELECT *, coalesce(max(off) OVER (PARTITION BY part ORDER BY t, kind, seq ROWS UNBOUNDED PRECEDING), 0) AS position FROM r) WHERE kind = 1""")
def checkpoint_snapshots_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions at every checkpoint that an order adds, and nowhere else; two partitions are finished and
    keep their last position in all later checkpoints."""
    log = events_log(spark, sf_dir)
    at = F.lit(FINISHED_AT).cast("timestamp_ntz")
    finished = (log.where((F.col("part") >= FINISHED_FROM) & (F.col("publish_time") < at))
                .groupBy("part").agg(F.max("off").alias("position")).withColumn("finished_at", at))
    return pg.snapshots_at(log, order_trace(spark, sf_dir)[0], _reader_parts(log), finished)


@register("effective_commits", f"{WR}, {TRACE_SQL} SELECT reader, ck, notified_at, note, effective, added_at FROM commits")
def effective_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which completion notifications commit cursors, of which adding of their checkpoint."""
    cks, notes = order_trace(spark, sf_dir)
    return pg.effective_commits(cks, notes).drop("seq")


@register("committed_cursors", f"""{WR}, {TRACE_SQL}, {COMMITTED_SQL.format(extra='')}
SELECT part, position FROM committed""")
def committed_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor of every partition after all effective commits."""
    return _committed(events_log(spark, sf_dir), pg.effective_commits(*order_trace(spark, sf_dir)))


def _crash(spark: SparkSession, sf_dir: str):
    log = events_log(spark, sf_dir)
    crash = F.lit(CRASH_AT).cast("timestamp_ntz")
    cks, notes = order_trace(spark, sf_dir)
    commits = pg.effective_commits(cks.where(F.col("added_at") < crash), notes.where(F.col("notified_at") < crash))
    return log, log.where(F.col("publish_time") < crash), _committed(log, commits)


_CRASH_SQL = f"""{WR}, {TRACE_SQL}, {COMMITTED_SQL.format(extra=f"AND notified_at < TIMESTAMP '{CRASH_AT}'")},
consumed AS (SELECT part, off FROM log WHERE publish_time < TIMESTAMP '{CRASH_AT}')"""


@register("redelivery", f"""{_CRASH_SQL}
SELECT c.part, c.off FROM consumed c LEFT JOIN committed k USING (part) WHERE k.position IS NULL OR c.off >= k.position""")
def redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered twice after a crash and a restart from committed cursors."""
    _, consumed, committed = _crash(spark, sf_dir)
    return pg.redelivered(consumed, committed, inclusive=True, part_bound=P).select("part", "off")


@register("dedup_redelivered", f"""{_CRASH_SQL}
SELECT DISTINCT part, off FROM (
  SELECT part, off FROM consumed
  UNION ALL
  SELECT l.part, l.off FROM log l LEFT JOIN committed k USING (part) WHERE k.position IS NULL OR l.off >= k.position)""")
def dedup_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both runs (before and after the restart) unioned, each message kept once."""
    log, consumed, committed = _crash(spark, sf_dir)
    return pg.dedup_by_position(consumed.select("part", "off"),
                                pg.resume_scan(log, committed, inclusive=True, part_bound=P).select("part", "off"),
                                part_bound=P)


@register("dedup_redelivered_any_order", f"""{_CRASH_SQL}
SELECT DISTINCT part, off FROM (
  SELECT part, off FROM consumed
  UNION ALL
  SELECT l.part, l.off FROM log l LEFT JOIN committed k USING (part) WHERE k.position IS NULL OR l.off >= k.position)""")
def dedup_redelivered_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs deduplicated without assuming read order (hash on part, off)."""
    log, consumed, committed = _crash(spark, sf_dir)
    return pg.dedup_redelivered(consumed.select("part", "off"),
                                pg.resume_scan(log, committed, inclusive=True, part_bound=P).select("part", "off"))


# ---------------------------------------------------------------- the larger lineitem log

LW = "WITH " + LINEITEM_LOG_SQL


@register("li_positions", f"{LW} SELECT part, max(off) AS position, count(*) AS n FROM log GROUP BY part")
def li_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions over the lineitem log (offsets numbered per partition)."""
    log = lineitem_log(spark, sf_dir)
    return pg.positions(to_records(log, K, tsf.publish_time()))


@register("li_ordered_scan", f"{LW} SELECT part, off, lag(off) OVER (PARTITION BY part ORDER BY off) AS prev_off, attr FROM log")
def li_ordered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem log in offset order with the previous offset of each row."""
    log = lineitem_log(spark, sf_dir).select("part", "off", "attr")
    return prev_offset(log, width=4096).select("part", "off", "prev_off", "attr")


@register("li_scan_from_cursor", f"""{LW},
cur AS (SELECT part, max(off) AS off FROM log WHERE publish_time < TIMESTAMP '{LI_CURSOR_AS_OF}' GROUP BY part)
SELECT l.part, l.off, l.value FROM log l LEFT JOIN cur c USING (part) WHERE l.off >= coalesce(c.off, 0)""")
def li_scan_from_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem log read from cursors as of 1998-01-01."""
    log = lineitem_log(spark, sf_dir)
    starts = scan.start_offsets(scan.topic_partitions(log), scan.cursors_as_of(log, LI_CURSOR_AS_OF),
                                part_bound=LINEITEM_PARTITIONS)
    return scan.scan_from(log, starts, part_bound=LINEITEM_PARTITIONS).select("part", "off", "value")


@register("li_checkpoint_snapshots", f"""{LW},
x AS (SELECT part, CAST(CAST(publish_time AS DATE) - DATE '{LI_EPOCH}' AS BIGINT) // {LI_CK_DAYS} AS ck, max(off) AS m FROM log GROUP BY ALL),
parts AS (SELECT CAST(range AS INTEGER) AS part FROM range(0, (SELECT max(part) + 1 FROM log))),
cks AS (SELECT range AS ck FROM range((SELECT min(ck) FROM x), (SELECT max(ck) FROM x) + 1))
SELECT p.part % {READERS} AS reader, c.ck, p.part,
       coalesce(max(x.m) OVER (PARTITION BY p.part ORDER BY c.ck ROWS UNBOUNDED PRECEDING), 0) AS position
FROM parts p CROSS JOIN cks c LEFT JOIN x ON x.part = p.part AND x.ck = c.ck""")
def li_checkpoint_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of the lineitem log at a barrier every 30 days of ship date."""
    log = lineitem_log(spark, sf_dir)
    ck = F.floor(_day(epoch=LI_EPOCH) / LI_CK_DAYS)
    return pg.checkpoint_snapshots(log, ck, READERS)


@register("discover_empty_tail", f"""{W} SELECT CAST(range AS INTEGER) AS part, 0 AS start_off
FROM range(0, (SELECT max(part) + 4 FROM log)) WHERE range NOT IN (SELECT DISTINCT part FROM log)""")
def discover_empty_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic has three partitions more than ever got a message; they are discovered too."""
    log = events_log(spark, sf_dir)
    known = log.select("part").distinct()
    count = log.agg(F.max("part") + 4).first()[0]
    none = spark.createDataFrame([], "part INT, off BIGINT")
    found = scan.discover(scan.topic_partitions_of(spark, count), known, none, "subscriptions/events-reader")
    return found.select("part", F.col("start_off").cast("int").alias("start_off"))


@register("cursors_two_subscriptions", f"""{W},
fast AS (SELECT part, max(off) AS start_off FROM log GROUP BY part),
slow AS (SELECT part, max(off) AS start_off FROM log WHERE publish_time < TIMESTAMP '{CURSOR_AS_OF}' GROUP BY part)
SELECT 'fast' AS subscription, part, start_off FROM fast
UNION ALL SELECT 'slow', p.part, coalesce(s.start_off, 0) FROM (SELECT DISTINCT part FROM log) p LEFT JOIN slow s USING (part)""")
def cursors_two_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subscriptions commit to one cursor table; each starts from its own cursors."""
    log = events_log(spark, sf_dir)
    parts = scan.topic_partitions(log)
    ahead = log.groupBy("part").agg(F.max("off").alias("off"))
    cursors = ahead.withColumn("subscription", F.lit("fast")).unionByName(
        scan.cursors_as_of(log, CURSOR_AS_OF).withColumn("subscription", F.lit("slow")))
    starts = [scan.start_offsets(parts, scan.cursors_of(cursors, s)).select(F.lit(s).alias("subscription"), "part", "start_off")
              for s in ("fast", "slow")]
    return starts[0].unionByName(starts[1])
