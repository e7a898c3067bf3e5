"""Envelope schema of a log and the fixed values the semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per message.  ``off`` is unique and increasing inside a ``part`` but may have gaps.
LOG_DDL = ("part INT, off BIGINT, publish_time TIMESTAMP_NTZ, event_time TIMESTAMP_NTZ, "
           "data STRING, attr STRING, value DOUBLE")
LOG_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("off", T.LongType()),
    T.StructField("publish_time", T.TimestampNTZType()), T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("data", T.StringType()), T.StructField("attr", T.StringType()),
    T.StructField("value", T.DoubleType())])

# The same with every field a message has: bytes, an ordering key, attributes with repeated values.
MESSAGE_DDL = ("part INT, off BIGINT, publish_time TIMESTAMP_NTZ, event_time TIMESTAMP_NTZ, "
               "key BINARY, data BINARY, attributes MAP<STRING, ARRAY<BINARY>>")
MESSAGE_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("off", T.LongType()),
    T.StructField("publish_time", T.TimestampNTZType()), T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("key", T.BinaryType()), T.StructField("data", T.BinaryType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.ArrayType(T.BinaryType())))])

# A split: one partition of one subscription, read from ``start_off``.
SPLIT_DDL = "subscription STRING, part INT, start_off BIGINT"

# Fixed values (they must equal the connector's for the same results):
#   - timestamps are cut to milliseconds
#   - "no timestamp" sentinel of a record / watermark is Long.MIN_VALUE
#   - default max outstanding publish bytes is 100 MiB
#   - split / enumerator state version is 0
#   - a partition with no committed cursor starts at offset 0
#   - split id format is "<partition>-<start offset>-<subscription>"
TIMESTAMP_UNIT = "millisecond"
NO_TIMESTAMP = -(2**63)
DEFAULT_MAX_OUTSTANDING_BYTES = 104_857_600
STATE_VERSION = 0
DEFAULT_START_OFFSET = 0
SPLIT_ID_FORMAT = "%d-%d-%s"


def require_columns(df, cols, what="log") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; has {df.columns}")
