"""Spark session helpers.

The log's timestamps are wall-clock ``TIMESTAMP_NTZ`` values read as UTC; the conversions in
``tidelog.functions.timestamps`` use wall-clock fields only, so results do not depend on the session
time zone.  The session helper still pins UTC for anything a user adds.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpointed ranges (index_within) are deleted once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` on ``total_cores`` executor cores.

    Scan splits and shuffle partitions aim at ~256 MiB each, so a task's share fits executor memory
    without spilling much; the shuffle starts with at least three waves of tasks and AQE merges small
    partitions back to the advisory size and splits skewed ones.  A 100 TB read on 8,000 cores gives
    about 400,000 shuffle partitions.
    """
    parts = max(3 * total_cores, -(-int(input_bytes) // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_PARTITION_BYTES),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.execution.rangeExchange.sampleSizePerPartition": "200",
    }


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tidelog", extra: dict[str, str] | None = None,
              input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on; with ``input_bytes``
    and ``total_cores`` also the sizing of :func:`cluster_conf`."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if input_bytes and total_cores:
        conf.update(cluster_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


_FALLBACK_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read as is; without it a cluster job fails here.
    Only on a local master (tests) the SparkContext's checkpoint folder is used, or a folder under the system temp dir is
    taken once per application and registered with ``setCheckpointDir``.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _FALLBACK_ROOTS.get(sc.applicationId) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidelog-ckpt-")
        _FALLBACK_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tidelog", f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers: one zip per application (code only), handed to ``addPyFile``,
    which Spark sends to every executor, later ones included."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tidelog-package-"), "tidelog_package"), "zip",
                                 os.path.dirname(package), os.path.basename(package))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
