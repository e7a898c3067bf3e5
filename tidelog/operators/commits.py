"""The checkpoint commit rule over traces in which checkpoint ids come again.

A reader holds its checkpoints in the order in which they were added.  Adding an id that is still held
replaces its value where it stands; an id that was committed or dropped is added at the end again.  A
completion of a held id commits its value and drops it with all that stand before it; any other completion
does nothing.

What a completion does depends on all earlier events of its reader, so a reader's events are folded in
order.  They stream through one task sorted by time and are not collected: what is held is the reader's
open checkpoints.  Readers are independent and spread over the tasks.  Traces in which a reader adds each
id once have a closed form that also splits a reader (:func:`tidelog.operators.progress.effective_commits`
takes the fold only for readers with repeated ids).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import ship_code

ADD, COMPLETE = 0, 1


class Pending:
    """The open checkpoints of one reader: id -> value, in the order of their adding."""

    def __init__(self):
        self.held: dict = {}

    def add(self, ck, value) -> None:
        self.held[ck] = value

    def complete(self, ck):
        """The value that is committed, or None."""
        if ck not in self.held:
            return None
        value = self.held[ck]
        for older in list(self._until(ck)):
            del self.held[older]
        return value

    def _until(self, ck) -> Iterator:
        for k in self.held:
            yield k
            if k == ck:
                return


def trace_events(checkpoints: DataFrame, notifications: DataFrame) -> DataFrame:
    """``reader, ck, at, kind, tie``: adds (ties by ``seq``) and completions (ties by ``ck``, then ``note`` if
    there is one) in one table; at one instant adds come first."""
    note = F.col("note") if "note" in notifications.columns else F.lit(0)
    return checkpoints.select("reader", "ck", F.col("added_at").alias("at"), F.lit(ADD).alias("kind"),
                              F.struct(F.col("seq").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).alias("tie")).unionByName(
        notifications.select("reader", "ck", F.col("notified_at").alias("at"), F.lit(COMPLETE).alias("kind"),
                             F.struct(F.col("ck").cast("bigint").alias("a"), note.cast("bigint").alias("b")).alias("tie")))


def fold_commits(events: DataFrame) -> DataFrame:
    """``reader, ck, notified_at, note, effective, added_at, seq`` of every completion of ``events``
    (:func:`trace_events`): whether it commits, and when the committed value was added and its ``seq``."""
    kinds = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    spark = events.sparkSession
    ship_code(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (events.select("reader", "ck", "at", "kind", F.col("tie.a").alias("a"), F.col("tie.b").alias("b"))
               # by an expression that no step before is dealt by: the planner takes a union of parts dealt by
               # reader for dealt by reader, although adaptive joins may still undo that in one of them
               .repartition(n, F.xxhash64("reader")).sortWithinPartitions("reader", "at", "kind", "a", "b"))

    def run(batches):
        now, pending = object(), None
        for batch in batches:
            out = []
            for reader, ck, at, kind, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if reader != now:
                    now, pending = reader, Pending()
                if kind == ADD:
                    pending.add(ck, (at, a))
                else:
                    value = pending.complete(ck)
                    out.append((reader, ck, at, b, value is not None, *(value or (None, None))))
            if out:
                columns = list(zip(*out))
                types = [batch.schema.field(0).type, batch.schema.field(1).type, batch.schema.field(2).type, pa.int64(), pa.bool_(),
                         batch.schema.field(2).type, pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 names=["reader", "ck", "notified_at", "note", "effective", "added_at", "seq"])

    return ordered.mapInArrow(run, f"reader {kinds['reader']}, ck {kinds['ck']}, notified_at {kinds['at']}, note bigint, "
                                   f"effective boolean, added_at {kinds['at']}, seq bigint")
