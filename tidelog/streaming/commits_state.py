"""The checkpoint commit rule as keyed state of a stream (:func:`tidelog.operators.commits` in batch).

A stream of events ``reader, ck, at, kind, tie_a, tie_b`` (adds and completions, each reader's in time order
from batch to batch) is grouped by reader.  The state of a reader is a map of its open checkpoints, id ->
(place in the order of adding, when added, ``seq``), and the next place.  Adding a held id keeps its place;
a completion removes every id up to the place of its own.  So state is the open checkpoints, in the state
store, and a restart continues from the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.commits import ADD, Pending
from tidelog.streaming.stream import run_to_files

OUT = "reader bigint, ck bigint, notified_at bigint, note bigint, effective boolean, added_at bigint, seq bigint"


class CommitProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "ck bigint", "place bigint, added_at bigint, seq bigint")
        self.next = handle.getValueState("next", "place bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # the events of one reader in one batch, in order
        events = pd.concat(list(rows)).sort_values(["at", "kind", "tie_a", "tie_b"], kind="stable")
        before = {k[0]: tuple(v) for k, v in self.open.iterator()}
        place = self.next.get()[0] if self.next.exists() else 0
        pending, out = Pending(), []
        for ck, value in sorted(before.items(), key=lambda x: x[1][0]):
            pending.add(ck, value)
        for ck, at, kind, a, b in zip(*(events[c].tolist() for c in ("ck", "at", "kind", "tie_a", "tie_b"))):
            if kind == ADD:
                here = pending.held.get(ck)
                pending.add(ck, (here[0] if here else place, at, a))
                place += 0 if here else 1
            else:
                value = pending.complete(ck)
                out.append((key[0], ck, at, b, value is not None, *(value[1:] if value else (None, None))))
        for ck in before.keys() - pending.held.keys():
            self.open.removeKey((ck,))
        for ck, value in pending.held.items():
            if before.get(ck) != value:
                self.open.updateValue((ck,), value)
        self.next.update((place,))
        if out:
            frame = pd.DataFrame(out, columns=["reader", "ck", "notified_at", "note", "effective", "added_at", "seq"])
            yield frame.astype({"added_at": "Int64", "seq": "Int64"})

    def close(self) -> None:
        pass


def commit_stream(events: DataFrame) -> DataFrame:
    """``reader, ck, notified_at, note, effective, added_at, seq`` of every completion in a stream of
    ``reader, ck, at, kind, tie_a, tie_b`` (all BIGINT but ``kind``)."""
    typed = events.select(*[F.col(c).cast("bigint").alias(c) for c in ("reader", "ck", "at")], F.col("kind").cast("int").alias("kind"),
                          *[F.col(c).cast("bigint").alias(c) for c in ("tie_a", "tie_b")])
    return typed.groupBy("reader").transformWithStateInPandas(CommitProcessor(), OUT, "Append", "None")


def run_commit_stream(events: DataFrame, out: str, checkpoint: str) -> None:
    """Writes :func:`commit_stream` of ``events`` to ``out`` until the input is drained.  Keyed state of this kind
    needs the RocksDB state store; the query takes the setting along, the session keeps its own."""
    spark, name = events.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        run_to_files(commit_stream(events), out, checkpoint)
    finally:
        spark.conf.set(name, before)
