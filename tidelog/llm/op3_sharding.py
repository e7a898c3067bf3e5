"""Weighted rendezvous sharding of stable record keys, and gapless slots inside the shards.

A key's score in a shard is ``-ln(u) / weight`` with ``u`` from the MD5 of key and shard; the key goes
to the shard of the least score.  Only key, shard ids and weights decide, so rows are placed in one
scan without a shuffle, and one more shard draws about ``weight / total weight`` of the keys into
itself and moves no other.

Slots number each shard's rows from 0 in (key, CRC) order.  The narrow rows (no text) are range-sorted
over the cluster and written once to the checkpoint folder, so that counts and numbers come from the
same ranges; a slot is the rows of earlier ranges of the shard plus the row number inside the range.
A shard, or a key that repeats often, spans as many ranges as it needs: no task gets a whole shard.

Defined cases: a null key is a key of its own (all such rows share a shard); a null text has size 8
and the CRC of no bytes (0); rows with equal keys share the shard and get different slots; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.session import checkpoint_root

from .base import documents

NAME = "op3_sharding"
SHARDS = 24
OVERHEAD = 8


def unit_hash(key: Column, shard: int) -> Column:
    """A number in (0, 1) from the first 52 bits of ``md5(key ':' shard)``; a null key reads ``null``."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(shard)))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard of least ``-ln(u) / weight`` among the shards of positive weight; ties go to the lower one."""
    scores = [F.struct((-F.ln(unit_hash(key, s)) / F.lit(float(w))).alias("score"), F.lit(s).alias("shard"))
              for s, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("no shard has a positive weight")
    return F.array_min(F.array(*scores))["shard"]


def slots(rows: DataFrame, shard: str, order: Sequence[str], out: str = "slot", ranges: int | None = None) -> DataFrame:
    """Number the rows of each shard from 0 in ``order``; see the module text for how."""
    spark = rows.sparkSession
    checkpoint_root(spark)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the tie column only splits rows that are equal in `order`
    keys = [shard, *order, "__tie"]
    ranged = (rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
              .withColumn("__range", F.spark_partition_id()).checkpoint())
    counted = ranged.groupBy(shard, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(shard, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard, "__range").orderBy(*order, "__tie")
    return (ranged.withColumn("__row", F.row_number().over(inside) - 1).join(starts, [shard, "__range"])
            .withColumn(out, F.col("__start") + F.col("__row")).drop("__tie", "__range", "__row", "__start"))


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * SHARDS,
          grown: Sequence[float] | None = None) -> DataFrame:
    """Per row: key, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard``, the shard under
    ``grown`` (default: one more shard of the mean weight)."""
    grown = grown or (*weights, sum(weights) / len(weights))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key), (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
                       F.crc32(body).alias("text_crc32"), shard_of(F.col(key), weights).alias("shard"),
                       shard_of(F.col(key), grown).alias("grown_shard"))
    return slots(rows, "shard", [key, "text_crc32", "size"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 equal shards by doc_id."""
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard")


_SCORE = "(-ln((('0x' || substr(md5(k || ':' || s::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0), s)"
SQL = f"""
WITH tab AS (SELECT list_transform(range(0, 256), lambda n: list_reduce(list_concat([n], range(0, 8)),
               lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, 'null') AS k FROM documents),
b AS (SELECT rid, doc_id, k, octet_length(encode(t)) + 8 AS size, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM d),
c AS (SELECT rid, doc_id, k, size::BIGINT AS size, xor(list_reduce(list_concat([4294967295], bytes),
        lambda c, x: xor(c >> 8, tab.t[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, tab),
s AS (SELECT *, list_min(list_transform(range(0, {SHARDS}), lambda s: {_SCORE}))[2]::INTEGER AS shard,
             list_min(list_transform(range(0, {SHARDS + 1}), lambda s: {_SCORE}))[2]::INTEGER AS grown_shard FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown_shard FROM s
"""
