"""Reading folders that may not have been written yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is no such path.  Any other failure is raised: an
    unreadable table must not look like an empty one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def batch_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Batch id -> folder, for the finished (``_SUCCESS``) folders ``path/batch=<id>``.  One listing by the
    file system that ``path`` names."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "batch=*/_SUCCESS"))
    folders = (s.getPath().getParent() for s in done or [])
    return {int(f.getName().split("=", 1)[1]): f.toString() for f in folders}


#: Changes of a topic's partition count that are read to the driver; more are an error.
HISTORY_ROWS = 10_000


def partition_history(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """``(from_ms, count)`` of every change of a topic's partition count, from the table ``from_ms, count`` at ``path``."""
    rows = spark.read.parquet(path).select("from_ms", "count").distinct().limit(HISTORY_ROWS + 1).collect()
    if len(rows) > HISTORY_ROWS:
        raise ValueError(f"more than {HISTORY_ROWS} changes of the partition count at {path}")
    return sorted((int(r["from_ms"]), int(r["count"])) for r in rows)
