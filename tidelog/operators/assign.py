"""Sticky least-loaded assignment of keys (splits) to tasks.

Rule: each unassigned key, in arrival order, goes to the task holding the fewest keys, ties to the
lowest task id; keys already assigned never move.  Done as a driver loop this is a heap; here it
is a closed form that runs as joins:

* Task ``t`` holding ``c_t`` keys offers one slot per level ``c_t, c_t + 1, ...``.  Serving keys
  in arrival order from the heap equals taking slots in ``(level, task)`` order, so the key of
  rank ``r`` gets slot ``r``.
* ``m`` new keys reach a *water level*: with the counts sorted and summed up, raising the ``k`` least loaded
  tasks to the ``k``-th count takes ``k c_k - (c_1 + .. + c_k)`` keys; the last ``k`` for which ``m`` suffices
  gives the level ``(m + c_1 + .. + c_k) div k``.  Only the slots up to it are listed, at most ``m`` plus one
  for each task, however uneven the counts are.  They are ranked by ``(level, task)`` and joined to
  the keys by rank.
* Where the level exceeds the highest count ``L``, the slots below ``L`` are listed, ``S`` in all, and from rank
  ``S`` on every task takes part in turn: ``task = (r - S) mod tasks``.

Ranks of keys and slots come from :func:`index_within` (range partitioned, no single-task window), and ranks
meet by an equi-join.  Only the sort of the counts is one task: one row for each task of the job.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.broadcast import broadcast_bounded
from tidelog.operators.ordered import index_within


def upsert_splits(events: DataFrame, keys: Sequence[str] = ("part",), seq: str = "seq") -> DataFrame:
    """Latest version of every split wins.

    ``events``: ``*keys, start_off, task, seq``; a re-add carries a null ``task``, so re-adding a
    split replaces it and clears its assignment.  Partial aggregation keeps hot keys cheap."""
    latest = events.groupBy(*keys).agg(F.max_by(F.struct("start_off", "task"), seq).alias("_s"))
    return latest.select(*keys, F.col("_s.start_off").alias("start_off"), F.col("_s.task").alias("task"))


def _check_tasks(num_tasks: int) -> None:
    if num_tasks < 1:
        raise ValueError("parallelism must be at least one")


def task_counts(spark, assigned: DataFrame, num_tasks: int) -> DataFrame:
    """``task, c``: keys held by every task ``0 .. num_tasks - 1`` (zero included)."""
    counts = assigned.where(F.col("task").isNotNull()).groupBy("task").agg(F.count(F.lit(1)).alias("_c"))
    tasks = spark.range(num_tasks).select(F.col("id").cast("int").alias("task"))
    return (tasks.join(broadcast_bounded(counts.where(F.col("task") < num_tasks), num_tasks), "task", "left")
            .select("task", F.coalesce("_c", F.lit(0)).cast("bigint").alias("c")))


def water_level(counts: DataFrame, new_keys: int) -> int | None:
    """The number of keys that the least loaded tasks hold, rounded down, after ``new_keys`` more."""
    w = Window.orderBy("c", "task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.select("c", F.count(F.lit(1)).over(w).alias("k"), F.sum("c").over(w).alias("held"))
    enough = summed.where(F.col("k") * F.col("c") - F.col("held") <= F.lit(int(new_keys)))
    return enough.agg(F.max_by(F.expr(f"({int(new_keys)} + held) DIV k"), "k")).first()[0]


def leveling_slots(counts: DataFrame, top: int) -> DataFrame:
    """``_r, task``: the slots of all tasks below level ``top``, ranked by level, then task."""
    slots = counts.where(F.col("c") < top).select("task", F.explode(F.sequence("c", F.lit(top - 1).cast("bigint"))).alias("level"))
    return index_within(slots, [], ["level", "task"], out="_r", group_bound=0).select("_r", "task")


def assign_least_loaded(keys: DataFrame, order_cols: Sequence[str], num_tasks: int,
                        existing: DataFrame | None = None, registered: Sequence[int] | None = None,
                        key: str = "key") -> DataFrame:
    """``key, task`` for every key.

    ``keys``: all keys with their arrival-order columns.  ``existing``: ``key, task`` already
    enacted (null task = known but unassigned).  The proposal covers all ``num_tasks`` tasks; with
    ``registered`` only proposals to registered tasks are enacted, the rest stay null.
    """
    _check_tasks(num_tasks)
    spark = keys.sparkSession
    if existing is None:
        existing = keys.select(key, F.lit(None).cast("int").alias("task")).limit(0)
    held = existing.where(F.col("task").isNotNull()).select(key, F.col("task").cast("int").alias("task"))
    counts = task_counts(spark, held, num_tasks)
    fresh = keys.join(held.select(key), key, "left_anti").select(*dict.fromkeys([key, *order_cols]))
    ranked = index_within(fresh, [], list(order_cols), out="_r", group_bound=0).select("_r", key)
    low, high, sum_held = counts.agg(F.min("c"), F.max("c"), F.sum("c")).first()
    total = high * num_tasks - sum_held
    # keys after the leveling slots: every task takes part in turn
    if high == low:
        placed = ranked.select(key, F.pmod(F.col("_r"), F.lit(num_tasks)).cast("int").alias("task"))
    else:
        # the level that is being filled when the keys run out is listed too
        slots = leveling_slots(counts, min(high, water_level(counts, ranked.count()) + 1))
        placed = (ranked.where(F.col("_r") >= F.lit(total))
                  .select(key, F.pmod(F.col("_r") - F.lit(total), F.lit(num_tasks)).cast("int").alias("task"))
                  .unionByName(ranked.where(F.col("_r") < F.lit(total)).join(slots, "_r").select(key, "task")))
    if registered is not None:
        reg = [int(t) for t in registered]
        placed = placed.select(key, F.when(F.col("task").isin(reg), F.col("task")).cast("int").alias("task"))
    return held.select(key, "task").unionByName(placed)


def tasks_view(assignments: DataFrame, tasks: Sequence[int]) -> DataFrame:
    """``task, n`` for every listed task, zero when it holds nothing."""
    spark = assignments.sparkSession
    t = spark.createDataFrame([(int(x),) for x in tasks], "task INT")
    counts = assignments.where(F.col("task").isNotNull()).groupBy("task").agg(F.count(F.lit(1)).alias("_n"))
    return t.join(counts, "task", "left").select("task", F.coalesce("_n", F.lit(0)).alias("n"))


def task_load(assignments: DataFrame) -> DataFrame:
    """``task, n``: keys per assigned task."""
    return (assignments.where(F.col("task").isNotNull()).groupBy("task")
            .agg(F.count(F.lit(1)).alias("n")))


def return_tasks(assignments: DataFrame, returned_tasks: Sequence[int], key: str = "key") -> DataFrame:
    """Keys of failed tasks go back to the pool: their task is cleared (a newer re-add)."""
    ret = [int(t) for t in returned_tasks]
    task = F.col("task").cast("int")
    return assignments.select(key, F.when(~task.isin(ret), task).alias("task"))
