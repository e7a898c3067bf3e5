"""Assignment side: split upserts, sticky least-loaded assignment, registration, restore, returns.

Keys are customers (``c_custkey``) arriving in key order; 6 tasks.  Existing assignment for the
incremental rounds: keys with ``c_custkey % 3 = 0`` on task ``c_custkey % 4``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import assign as asg
from tidelog.plans.log_queries import STARTS_SQL, W, _starts
from tidelog.plans.registry import register
from tidelog.session import scratch_dir
from tidelog.sources.logs import events_log, table

TASKS = 6
REGISTERED = (0, 2, 3)
RETURNED = (1,)


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))


def _existing(keys: DataFrame) -> DataFrame:
    return keys.where(F.col("key") % 3 == 0).select("key", (F.col("key") % 4).cast("int").alias("task"))


# DuckDB: the slot form - every task t offers levels c_t .. c_t + m - 1, slots in (level, task) order.
def _slots_sql(existing: str, new: str, sfx: str = "", tasks: int = TASKS) -> str:
    return f"""
tasks{sfx} AS (SELECT CAST(range AS INTEGER) AS task FROM range(0, {tasks})),
cnt{sfx} AS (SELECT t.task, count(e.key) AS c FROM tasks{sfx} t LEFT JOIN ({existing}) e ON e.task = t.task GROUP BY t.task),
newk{sfx} AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS r FROM ({new})),
slots{sfx} AS (SELECT task, lvl, row_number() OVER (ORDER BY lvl, task) - 1 AS r
          FROM cnt{sfx}, LATERAL (SELECT range AS lvl FROM range(c, c + (SELECT count(*) FROM newk{sfx}) + 1))),
placed{sfx} AS (SELECT n.key, s.task FROM newk{sfx} n JOIN slots{sfx} s USING (r))"""


EXISTING_SQL = "SELECT c_custkey AS key, CAST(c_custkey % 4 AS INTEGER) AS task FROM customer WHERE c_custkey % 3 = 0"
NEW_SQL = "SELECT c_custkey AS key FROM customer WHERE c_custkey % 3 <> 0"
INCR_SQL = f"""WITH {_slots_sql(EXISTING_SQL, NEW_SQL)},
incr AS (SELECT key, task FROM ({EXISTING_SQL}) UNION ALL SELECT key, task FROM placed)"""
REG_SQL = f"""WITH {_slots_sql(EXISTING_SQL, NEW_SQL)},
reg AS (SELECT key, task FROM ({EXISTING_SQL})
        UNION ALL SELECT key, CASE WHEN task IN {REGISTERED} THEN task END FROM placed)"""


@register("assign_fresh", f"""WITH {_slots_sql("SELECT CAST(NULL AS BIGINT) AS key, CAST(NULL AS INTEGER) AS task WHERE false",
                                                "SELECT c_custkey AS key FROM customer")}
SELECT key, task FROM placed""")
def assign_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers on 6 empty tasks, least loaded first."""
    keys = _keys(spark, sf_dir)
    return asg.assign_least_loaded(keys, ["key"], TASKS)


@register("assign_incremental", f"{INCR_SQL} SELECT key, task FROM incr")
def assign_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New customers on 6 tasks that already hold some; existing keys never move."""
    keys = _keys(spark, sf_dir)
    return asg.assign_least_loaded(keys, ["key"], TASKS, existing=_existing(keys))


@register("assign_registered", f"{REG_SQL} SELECT key, task FROM reg")
def assign_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposal over all 6 tasks, enacted only for the registered tasks 0, 2, 3."""
    keys = _keys(spark, sf_dir)
    return asg.assign_least_loaded(keys, ["key"], TASKS, existing=_existing(keys), registered=REGISTERED)


@register("assign_restore", f"""{REG_SQL},
{_slots_sql("SELECT key, task FROM reg WHERE task IS NOT NULL", "SELECT key FROM reg WHERE task IS NULL", "2")}
SELECT key, task FROM reg WHERE task IS NOT NULL UNION ALL SELECT key, task FROM placed2""")
def assign_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments (some unassigned) exported to the checkpoint folder, read back, completed."""
    keys = _keys(spark, sf_dir)
    first = asg.assign_least_loaded(keys, ["key"], TASKS, existing=_existing(keys), registered=REGISTERED)
    path = scratch_dir(spark, "assignments")
    first.write.parquet(path)
    restored = spark.read.schema("key BIGINT, task INT").parquet(path)
    return asg.assign_least_loaded(restored.select("key"), ["key"], TASKS, existing=restored)


@register("assign_after_return", f"""{INCR_SQL},
back AS (SELECT key, CASE WHEN task IN {RETURNED} THEN NULL ELSE task END AS task FROM incr),
{_slots_sql("SELECT key, task FROM back WHERE task IS NOT NULL", "SELECT key FROM back WHERE task IS NULL", "2")}
SELECT key, task FROM back WHERE task IS NOT NULL UNION ALL SELECT key, task FROM placed2""")
def assign_after_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 fails: its keys return to the pool (re-added, task cleared) and are reassigned."""
    keys = _keys(spark, sf_dir)
    path = scratch_dir(spark, "assignments")
    asg.assign_least_loaded(keys, ["key"], TASKS, existing=_existing(keys)).write.parquet(path)
    back = asg.return_tasks(spark.read.parquet(path), RETURNED)
    return asg.assign_least_loaded(back.select("key"), ["key"], TASKS, existing=back)


@register("assign_string_keys", f"""WITH {_slots_sql("SELECT c_name AS key, CAST(c_custkey % 4 AS INTEGER) AS task FROM customer WHERE c_custkey % 3 = 0",
                                                     "SELECT c_name AS key FROM customer WHERE c_custkey % 3 <> 0")}
SELECT c_name AS key, CAST(c_custkey % 4 AS INTEGER) AS task FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT key, task FROM placed""")
def assign_string_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental round with string keys (customer names)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("key"), "c_custkey")
    held = c.where(F.col("c_custkey") % 3 == 0).select("key", (F.col("c_custkey") % 4).cast("int").alias("task"))
    return asg.assign_least_loaded(c.select("key"), ["key"], TASKS, existing=held)


@register("task_load", f"{INCR_SQL} SELECT task, count(*) AS n FROM incr GROUP BY task")
def task_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys per task after the incremental round."""
    return asg.task_load(assign_incremental(spark, sf_dir))


@register("registered_tasks", f"""{REG_SQL}
SELECT t.task, count(r.key) AS n FROM (SELECT CAST(range AS INTEGER) AS task FROM range(0, {TASKS})) t
LEFT JOIN reg r ON r.task = t.task WHERE t.task IN {REGISTERED} GROUP BY t.task""")
def registered_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered task with the keys it holds, possibly none."""
    return asg.tasks_view(assign_registered(spark, sf_dir), REGISTERED)


@register("upsert_splits", f"""{W}, {STARTS_SQL},
ev AS (SELECT part, start_off, CAST(part % 3 AS INTEGER) AS task, 0 AS seq FROM starts
       UNION ALL SELECT part, start_off + 1, NULL, 1 FROM starts WHERE part IN (2, 5)
       UNION ALL SELECT part, start_off + 2, NULL, 2 FROM starts WHERE part = 5)
SELECT part, start_off, task FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY seq DESC) AS rn FROM ev) WHERE rn = 1""")
def upsert_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-added splits replace the older version of the same partition and clear its task."""
    s = _starts(events_log(spark, sf_dir))
    ev = (s.select("part", "start_off", (F.col("part") % 3).cast("int").alias("task"), F.lit(0).alias("seq"))
          .unionByName(s.where(F.col("part").isin(2, 5)).select(
              "part", (F.col("start_off") + 1).alias("start_off"), F.lit(None).cast("int").alias("task"), F.lit(1).alias("seq")))
          .unionByName(s.where(F.col("part") == 5).select(
              "part", (F.col("start_off") + 2).alias("start_off"), F.lit(None).cast("int").alias("task"), F.lit(2).alias("seq"))))
    return asg.upsert_splits(ev)
