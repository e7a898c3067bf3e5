"""Positions, checkpoint snapshots, effective commits, committed cursors and redelivery.

Position of a partition = offset of the last *consumed* message, skipped (undecodable) ones
included; the split's start offset when nothing was consumed.

Checkpoint commit rule: when checkpoint ``k`` of a reader completes and ``k`` is still pending,
its cursors are committed and every checkpoint the reader added before ``k`` is dropped; a
completion for an unknown or dropped checkpoint does nothing.  Where a reader adds each id once, with
insertion sequence ``seq``, a completion is effective iff its checkpoint was added by then and ``seq``
exceeds every ``seq`` completed earlier by the same reader - a running max, computed with
:func:`prefix_max`.  Readers that add an id again are folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.broadcast import broadcast_bounded
from tidelog.operators.commits import fold_commits, trace_events
from tidelog.operators.ordered import prefix_max
from tidelog.schema import DEFAULT_START_OFFSET

DEFAULT_CK_CHUNK = 1 << 12


def positions(records: DataFrame, splits: DataFrame | None = None,
              part_bound: int | None = None, all_partitions: bool = False) -> DataFrame:
    """``part, position, n``: last consumed offset and messages consumed per partition.

    ``records`` must still contain undecodable messages.  With ``splits`` (``part, start_off``)
    every split appears, at its start offset when nothing of it was consumed.  With
    ``all_partitions`` every partition ``0 .. max(part)`` appears (start offset 0); the partition
    list comes from the same aggregate, so the records are read once."""
    agg = records.groupBy("part").agg(F.max("off").alias("_pos"), F.count(F.lit(1)).alias("_n"))
    if all_partitions and splits is None:
        # one row per present partition (bounded by the partition count); each also emits the
        # absent partitions below the next present one, so no second pass over the records
        w = Window.orderBy("part")
        x = agg.withColumn("_next", F.lead("part").over(w)).withColumn("_rn", F.row_number().over(w))
        lo = F.when(F.col("_rn") == 1, F.lit(0)).otherwise(F.col("part"))
        hi = F.coalesce(F.col("_next") - 1, F.col("part"))
        e = x.select(F.explode(F.sequence(lo, hi)).alias("_p"), "part", "_pos", "_n")
        here = F.col("_p") == F.col("part")
        return e.select(F.col("_p").cast("int").alias("part"),
                        F.when(here, F.col("_pos")).otherwise(F.lit(DEFAULT_START_OFFSET).cast("bigint")).alias("position"),
                        F.when(here, F.col("_n")).otherwise(F.lit(0).cast("bigint")).alias("n"))
    if splits is None:
        return agg.select("part", F.col("_pos").alias("position"), F.col("_n").alias("n"))
    s = splits.select("part", "start_off")
    return (s.join(broadcast_bounded(agg, part_bound), "part", "left")
            .select("part", F.coalesce("_pos", "start_off").alias("position"),
                    F.coalesce("_n", F.lit(0).cast("bigint")).alias("n")))


def progress_summary(records: DataFrame) -> DataFrame:
    """``part, emitted, skipped, position``: values emitted, messages skipped, last position."""
    return records.groupBy("part").agg(
        F.count("value").alias("emitted"),
        F.count(F.when(F.col("value").isNull(), F.lit(1))).alias("skipped"),
        F.max("off").alias("position"))


def _chunk_of(col: str, dtype: T.DataType, width: int) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        from tidelog.functions.timestamps import epoch_micros
        return F.floor(epoch_micros(F.col(col)) / F.lit(3_600_000_000)).cast("bigint")
    return F.expr(f"cast(`{col}` as bigint) div {int(width)}")


def _bounds(log: DataFrame, ck_of_row: Column) -> DataFrame:
    return (log.select("part", ck_of_row.cast("bigint").alias("ck"))
            .agg((F.max("part") + 1).cast("int").alias("n"), F.min("ck").alias("lo"), F.max("ck").alias("hi")))


def checkpoint_barriers(log: DataFrame, ck_of_row: Column, readers: int) -> DataFrame:
    """``reader, ck``: every barrier of every reader, from one aggregate row of the log."""
    b = _bounds(log, ck_of_row).where(F.col("n") > 0)
    return (b.select(F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(readers)) - 1)).alias("reader"),
                     "lo", "hi")
            .select(F.col("reader").cast("int").alias("reader"), F.explode(F.sequence("lo", "hi")).alias("ck")))


def checkpoint_snapshots(log: DataFrame, ck_of_row: Column, readers: int,
                         starts: DataFrame | None = None, chunk_width: int = DEFAULT_CK_CHUNK) -> DataFrame:
    """``reader, ck, part, position`` at every checkpoint barrier.

    Checkpoint ``ck`` covers every message with ``ck_of_row <= ck`` (integer barrier index);
    barriers run from the first to the last index seen.  Partition ``p`` is read by reader
    ``p % readers``.  The log is first reduced to one max per (partition, barrier) - partial
    aggregation, so a hot partition costs nothing extra - then carried forward per partition.
    """
    per = (log.select("part", "off", ck_of_row.cast("bigint").alias("ck"))
           .groupBy("part", "ck").agg(F.max("off").alias("_m")))
    bounds = per.agg((F.max("part") + 1).cast("int").alias("n"), F.min("ck").alias("lo"),
                     F.max("ck").alias("hi"))
    # one row per partition, spread over tasks by partition, then one row per barrier
    grid = (bounds.where(F.col("n") > 0)
            .select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"), "lo", "hi")
            .repartition("part")
            .select("part", F.explode(F.sequence("lo", "hi")).alias("ck")))
    filled = grid.join(per, ["part", "ck"], "left")
    run = prefix_max(filled, ["part"], ["ck"], "_m", F.expr(f"ck div {int(chunk_width)}"), "_run")
    if starts is not None:
        run = run.join(starts.select("part", "start_off"), "part", "left")
        start = F.coalesce("start_off", F.lit(DEFAULT_START_OFFSET).cast("bigint"))
    else:
        start = F.lit(DEFAULT_START_OFFSET).cast("bigint")
    return run.select((F.col("part") % readers).cast("int").alias("reader"), "ck", "part",
                      F.coalesce(F.col("_run"), start).alias("position"))


def effective_commits(checkpoints: DataFrame, notifications: DataFrame,
                      chunk_width: int = DEFAULT_CK_CHUNK, prior: DataFrame | None = None) -> DataFrame:
    """``reader, ck, notified_at, [note,] effective, added_at, seq`` for every completion notification.

    ``checkpoints``: ``reader, ck, added_at, seq``, added in the order of ``added_at``, then ``seq``; an id that is added again while it is held replaces the
    value in place, otherwise it is a new checkpoint.  ``notifications``: ``reader, ck, notified_at`` and
    optionally ``note``; at equal ``notified_at`` ties go by ``ck`` (then ``note``), and an add at the same
    instant counts as before the notification.  ``added_at`` and ``seq`` are those of the committed value.

    Readers that add each id once have a closed form (a running max, split into chunks); the events of the
    others are folded (:mod:`tidelog.operators.commits`).  ``prior``: ``reader, max_seq`` completed before
    these notifications (incremental use, one row per reader; repeated ids are an error there)."""
    adds = checkpoints.groupBy("reader", "ck").agg(F.min("added_at").alias("added_at"), F.min("seq").alias("seq"), F.count(F.lit(1)).alias("_n"))
    extra = ["note"] if "note" in notifications.columns else []
    columns = ["reader", "ck", "notified_at", *extra, "effective", "added_at", "seq"]
    if prior is not None:
        twice = F.raise_error(F.concat(F.lit("checkpoint added twice: "), F.col("ck").cast("string")))
        adds = adds.withColumn("seq", F.when(F.col("_n") > 1, twice).otherwise(F.col("seq")))
        return _running_commits(adds, notifications, extra, chunk_width, prior).select(columns)
    again = adds.where("_n > 1").select("reader").distinct()
    once = _running_commits(adds.join(again, "reader", "left_anti"), notifications.join(again, "reader", "left_anti"), extra, chunk_width, None)
    folded = fold_commits(trace_events(checkpoints, notifications).join(again, "reader", "left_semi"))
    return once.select(columns).unionByName(folded.select([F.col(c).cast(once.schema[c].dataType) for c in columns]))


def _running_commits(adds: DataFrame, notifications: DataFrame, extra: list[str], chunk_width: int, prior: DataFrame | None) -> DataFrame:
    j = (notifications.select("reader", "ck", "notified_at", *extra)
         .join(adds.drop("_n"), ["reader", "ck"], "left")
         .withColumn("_seq", F.when(F.col("added_at") <= F.col("notified_at"), F.col("seq") if prior is not None else F.struct("added_at", "seq"))))
    chunk = _chunk_of("notified_at", j.schema["notified_at"].dataType, chunk_width)
    pm = prefix_max(j, ["reader"], ["notified_at", "ck", *extra], "_seq", chunk, "_prior", inclusive=False)
    if prior is not None:
        pm = (pm.join(prior.select("reader", F.col("max_seq").alias("_state")), "reader", "left")
              .withColumn("_prior", F.greatest("_prior", "_state")).drop("_state"))
    eff = F.coalesce(F.col("_seq").isNotNull() & (F.col("_prior").isNull() | (F.col("_seq") > F.col("_prior"))), F.lit(False))
    if prior is not None:
        return pm.withColumn("effective", eff).withColumn("seq", F.col("_seq"))
    return (pm.withColumn("effective", eff).withColumn("seq", F.when(F.col("effective"), F.col("seq")))
            .withColumn("added_at", F.when(F.col("effective"), F.col("added_at"))))


def committed_cursors(snapshots: DataFrame, commits: DataFrame) -> DataFrame:
    """``part, position``: the cursor each partition holds after all effective commits, i.e. the
    snapshot position of the last effective completion (in notification order) covering it.

    Snapshots with a ``seq`` (:func:`snapshots_at`) are those of one adding of a checkpoint id, and only the
    adding whose value was committed counts."""
    keys = ["reader", "ck"] + (["seq"] if "seq" in snapshots.columns else [])
    extra = ["note"] if "note" in commits.columns else []
    eff = commits.where("effective").select(*keys, "notified_at", *extra)
    j = snapshots.join(eff, keys)
    return j.groupBy("part").agg(
        F.max_by("position", F.struct("notified_at", "ck", *extra)).alias("position"))


def snapshots_at(log: DataFrame, barriers: DataFrame, parts: DataFrame, finished: DataFrame | None = None,
                 at: str = "publish_time") -> DataFrame:
    """``reader, ck, seq, added_at, part, position`` at every barrier that there is.

    ``barriers``: ``reader, ck, seq, added_at`` - one row for each adding of a checkpoint.  ``parts``: ``reader,
    part, start_off`` - who reads which partition, from where.  A barrier covers the messages with ``at`` up to
    ``added_at``.  ``finished``: ``part, position, finished_at`` - from then on the reader no longer holds the
    partition, but every checkpoint it adds still carries it, once, at its last position; messages after the
    finish do not count.

    Position changes (the log reduced to one row per partition and instant), finish events and barriers are
    merged in time order and the position is carried forward from row to row (running max in chunks of
    an hour), so the cost follows changes and barriers, never the time between them."""
    changes = log.select("part", "off", F.col(at).alias("at")).groupBy("part", "at").agg(F.max("off").alias("off"))
    kinds = {f.name: f.dataType for f in barriers.schema.fields}
    if finished is not None:
        end = finished.select("part", F.col("finished_at").alias("_end"), F.col("position").alias("_last"))
        changes = (changes.join(end, "part", "left").where(F.col("_end").isNull() | (F.col("at") <= F.col("_end")))
                   .select("part", "at", F.least("off", "_last").alias("off")))
        changes = changes.unionByName(end.select("part", F.col("_end").alias("at"), F.col("_last").cast("bigint").alias("off")))
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in ("reader", "ck", "seq")]
    rows = changes.select("part", "at", "off", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("start_off"), *empty).unionByName(
        barriers.select("reader", "ck", "seq", F.col("added_at").alias("at")).join(parts.select("reader", "part", "start_off"), "reader").select(
            "part", "at", F.lit(None).cast("bigint").alias("off"), F.lit(1).alias("kind"), F.col("start_off").cast("bigint").alias("start_off"),
            *[F.col(c).cast(kinds[c]).alias(c) for c in ("reader", "ck", "seq")]))
    run = prefix_max(rows, ["part"], ["at", "kind"], "off", _chunk_of("at", rows.schema["at"].dataType, DEFAULT_CK_CHUNK), "_run")
    return run.where("kind = 1").select("reader", "ck", "seq", F.col("at").alias("added_at"), "part",
                                        F.coalesce("_run", "start_off", F.lit(DEFAULT_START_OFFSET).cast("bigint")).alias("position"))


def redelivered(consumed: DataFrame, committed: DataFrame, inclusive: bool = True,
                part_bound: int | None = None) -> DataFrame:
    """Rows consumed before a restart that a restart from ``committed`` (``part, position``)
    reads again.  ``inclusive=True`` re-reads the committed offset itself, as the connector's
    seek does; a partition without a commit is re-read from its start."""
    c = broadcast_bounded(committed.select("part", F.col("position").alias("_c")), part_bound)
    j = consumed.join(c, "part", "left")
    cond = F.col("_c").isNull() | ((F.col("off") >= F.col("_c")) if inclusive else (F.col("off") > F.col("_c")))
    return j.where(cond).drop("_c")


def resume_scan(log: DataFrame, committed: DataFrame, inclusive: bool = True,
                part_bound: int | None = None) -> DataFrame:
    """What a restart from ``committed`` reads: every row at/after the cursor, all rows of
    partitions without a commit."""
    c = broadcast_bounded(committed.select("part", F.col("position").alias("_c")), part_bound)
    j = log.join(c, "part", "left")
    cond = F.col("_c").isNull() | ((F.col("off") >= F.col("_c")) if inclusive else (F.col("off") > F.col("_c")))
    return j.where(cond).drop("_c")


def dedup_by_position(first: DataFrame, second: DataFrame, part_bound: int | None = None) -> DataFrame:
    """Two runs of an in-order reader, the second resumed from a cursor at or before where the
    first stopped: the second run's rows at or below the first run's position (max offset per
    partition) are exactly the redelivered ones.  Drops them with a filter against that small
    table - no shuffle of the rows themselves."""
    pos = first.groupBy("part").agg(F.max("off").alias("_p"))
    fresh = (second.join(broadcast_bounded(pos, part_bound), "part", "left")
             .where(F.col("_p").isNull() | (F.col("off") > F.col("_p"))).drop("_p"))
    return first.unionByName(fresh)


def dedup_redelivered(*runs: DataFrame) -> DataFrame:
    """At-least-once runs unioned, each message kept once (by ``part, off``).  General form for
    runs in any order (hash shuffle on ``part, off`` with map-side dedup); for an in-order reader
    resumed from a cursor prefer :func:`dedup_by_position`."""
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out.dropDuplicates(["part", "off"])


def positions_from_footers(spark, path: str) -> DataFrame:
    """``part, position, n`` of a log folder written by :func:`tidelog.sources.logs.write_log`,
    answered from Parquet footers: ``max(off)`` and ``count(*)`` grouped by the ``part`` folder are
    pushed into the scan (one small record per file, no rows read).

    Runs in a child session (same SparkContext) with the DataSource V2 Parquet reader and aggregate
    pushdown switched on, so the caller's session settings stay as they are.  Files without
    statistics fall back to a normal scan; the result is the same either way.
    """
    from tidelog.schema import LOG_SCHEMA

    child = spark.newSession()
    child.conf.set("spark.sql.sources.useV1SourceList", "")
    child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    log = child.read.schema(LOG_SCHEMA).parquet(path)
    return log.groupBy("part").agg(F.max("off").alias("position"), F.count(F.lit(1)).alias("n"))
