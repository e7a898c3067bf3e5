"""tidelog: partitioned, offset-addressed message logs as Spark tables and streams.

A log is any DataFrame with the envelope columns of :data:`tidelog.schema.LOG_DDL`
(``part``, ``off``, ``publish_time``, ``event_time``, ``data``, ``attr``, ``value``).
Sub-packages:

* ``sources``   - building logs, scanning from / between cursors, partition discovery,
                  seeks on written logs.
* ``functions`` - Column factories: decoders, timestamp extractors, split ids, routing.
* ``operators`` - DataFrame operators: positions, checkpoint commits, redelivery,
                  sticky assignment, sink envelopes, skew-safe ordered helpers.
* ``streaming`` - Structured Streaming read / write with cursor commits.
* ``plans``     - the registered queries over the driver's test tables and their SQL.

The names below are the main entry points.
"""

from tidelog.functions.decode import data_only, full_message, json_field, utf8_text
from tidelog.functions.timestamps import event_time, publish_time
from tidelog.operators.assign import assign_least_loaded, upsert_splits
from tidelog.operators.progress import (checkpoint_snapshots, committed_cursors, dedup_by_position,
                                        effective_commits, positions, redelivered, resume_scan)
from tidelog.operators.records import emitted, records_for, to_records
from tidelog.operators.sink import encode_for, publish_to_log
from tidelog.options import FlowControl, LogSinkOptions, LogSourceOptions
from tidelog.session import checkpoint_root, cluster_conf, get_spark, scratch_dir
from tidelog.sources.logs import read_log, write_log
from tidelog.sources.scan import discover, scan_between, scan_from, start_offsets, topic_partitions
from tidelog.streaming.sink import start_log_sink
from tidelog.streaming.stream import open_log_stream

__all__ = [
    "get_spark", "checkpoint_root", "scratch_dir", "cluster_conf",
    "LogSourceOptions", "LogSinkOptions", "FlowControl",
    "read_log", "write_log", "topic_partitions", "start_offsets", "discover", "scan_from", "scan_between",
    "data_only", "full_message", "json_field", "utf8_text", "publish_time", "event_time",
    "to_records", "records_for", "emitted", "positions", "checkpoint_snapshots", "effective_commits",
    "committed_cursors", "redelivered", "resume_scan", "dedup_by_position",
    "assign_least_loaded", "upsert_splits", "encode_for", "publish_to_log",
    "open_log_stream", "start_log_sink",
]
