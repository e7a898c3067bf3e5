"""Small keyed tables that micro-batches keep between each other: snapshots plus deltas by batch id.

Batch ``b`` writes the rows of the keys it changed to ``delta/batch=b``; every ``every`` batches all keys are
also written to ``snapshot/batch=b``.  What holds before batch ``b`` is the newest finished snapshot before it
plus the deltas after that snapshot; of each key the rows of the last batch that wrote it count.  A replayed
batch reads only earlier batches and overwrites its own folders, and a snapshot that was not finished (no
``_SUCCESS`` marker) is not read, so a restart at any point gives the same rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.sources.paths import batch_folders

EVERY = 16


class BatchStore:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], every: int = EVERY):
        if every < 1:
            raise ValueError("a snapshot is written every n batches, n at least one")
        self.spark, self.path, self.keys, self.every = spark, path, list(keys), every

    def _folders(self, kind: str) -> dict[int, str]:
        return batch_folders(self.spark, f"{self.path}/{kind}")

    def read(self, before: int | None = None) -> DataFrame | None:
        """Rows in force before batch ``before`` (default: after all batches), or None if there are none."""
        return self._rows(before, before)

    def _rows(self, snapshot_before: int | None, delta_before: int | None) -> DataFrame | None:
        snapshots = {b: p for b, p in self._folders("snapshot").items() if snapshot_before is None or b < snapshot_before}
        base = max(snapshots, default=-1)
        deltas = {b: p for b, p in self._folders("delta").items() if b > base and (delta_before is None or b < delta_before)}
        found = ([(base, snapshots[base])] if base >= 0 else []) + sorted(deltas.items())
        if not found:
            return None
        rows = None
        for b, p in found:
            part = self.spark.read.parquet(p).withColumn("_batch", F.lit(b))
            rows = part if rows is None else rows.unionByName(part)
        if len(found) == 1:
            return rows.drop("_batch")
        last = F.max("_batch").over(Window.partitionBy(*self.keys))
        return rows.withColumn("_last", last).where("_batch = _last").drop("_batch", "_last")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """All rows of the keys that batch ``batch_id`` changed."""
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch_id}")
        if (batch_id + 1) % self.every == 0:
            # from an earlier snapshot: a replay must not read the one that it writes again
            self._rows(batch_id, batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/snapshot/batch={batch_id}")
