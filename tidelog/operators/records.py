"""Messages -> records -> emitted values, and fetch batches.

A record is ``part, off, value, ts``: the decoded value (null when undecodable) and the record
timestamp, computed for every message, decodable or not.  Emission drops null values; position
tracking must use the records *before* that filter (see :mod:`tidelog.operators.progress`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.decode import Decoder, decode
from tidelog.functions.timestamps import Extractor, epoch_ms, publish_time

DEFAULT_FETCH_SIZE = 64


def to_records(log: DataFrame, decoder: Decoder, extractor: Extractor | None = None,
               on_error: str = "skip") -> DataFrame:
    """``part, off, value, ts`` for every message."""
    ext = extractor or publish_time()
    d = decode(log, decoder, on_error=on_error)
    return d.select("part", "off", "value", ext(d).alias("ts"))


def emitted(records: DataFrame) -> DataFrame:
    """What reaches downstream: non-null values with the timestamp in epoch milliseconds."""
    return (records.where(F.col("value").isNotNull())
            .select("part", "off", "value", epoch_ms(F.col("ts")).alias("ts_ms")))


def fetch_batches(records: DataFrame, fetch_size: int = DEFAULT_FETCH_SIZE) -> DataFrame:
    """Group records into fetch batches ``part, fetch, records ARRAY<STRUCT<off, value, ts>>``.

    A batch is at most ``fetch_size`` consecutive offsets of one partition, so no batch grows
    with the log (offsets are unique per partition)."""
    return (records.withColumn("fetch", F.expr(f"off div {int(fetch_size)}"))
            .groupBy("part", "fetch")
            .agg(F.array_sort(F.collect_list(F.struct("off", "value", "ts"))).alias("records")))


def flatten_batches(batches: DataFrame) -> DataFrame:
    """Batches back to one row per record, tagged with its partition."""
    return (batches.select("part", F.explode("records").alias("r"))
            .select("part", F.col("r.off").alias("off"), F.col("r.value").alias("value"),
                    F.col("r.ts").alias("ts")))


def records_for(log: DataFrame, options) -> DataFrame:
    """Records of a log as ``options`` (:class:`tidelog.options.LogSourceOptions`) describe them:
    its decoder (default: the raw payload as text), timestamp extractor and error policy."""
    from tidelog.functions.decode import data_only, utf8_text

    decoder = options.decoder or data_only(utf8_text())
    return to_records(log, decoder, options.timestamp, on_error=options.on_error)
