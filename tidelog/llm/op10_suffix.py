"""Suffix-array dedup by names of growing prefixes.

The repeated strings of ``window`` bytes are the positions whose name by the first ``window`` bytes is
not unique.  Rounds name prefixes of growing length: Spark groups the (name, position) pairs of a round,
drops positions whose name is unique and goes on with longer prefixes for the others until the prefix
is past the threshold.  This stands in for prefix doubling: a name is a fingerprint made of the text
anew, no rank of an earlier round is joined at an offset.

Doubling every byte position would shuffle tens of bytes for each byte of text in each round, so the
early rounds rank blocks of neighbouring positions that share part of their prefix:

* round 0 ranks winnowed positions by ``lengths[0]`` bytes (``llm/anchors.py``); each string of
  ``window`` bytes holds one at a place that its content decides, so a unique rank there drops all
  positions it stands for, and runs that recur as a whole are repeats as a whole;
* a round of length ``h`` ranks blocks of ``window - h + 1`` neighbouring positions by the ``h`` bytes
  that all their strings share.  A unique rank drops the block; a block whose whole bytes recur is a
  repeat; the rest is split for the next round;
* in the last round ``h`` is ``window`` and a block is one position.

Copies of a text or passage are one row with a count in every round, so groups of any size cost what
one member costs.  Ranks are counted by partial aggregates and joined by the planner (adaptive skew
splitting).  What a round leaves is written to the checkpoint folder for the next one; each round and the
removal deal the texts once.  A repeat is decided by 128 bits (rank and
block bytes).

Defined cases: a null text is empty; a text shorter than the window stays whole; rows that repeat
(same id and text) are separate documents; null ids stay null; an empty table gives an empty result;
other columns are not read.  Removal may cut inside a UTF-8 character, so what is left is binary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import anchor_rows, batched_runs, merge_ranges, octets, pack, repeat_contexts, shared_anchors, unpack, with_runs
from .base import arrow_map, documents, flat, row_key, written
from .rolling import Prefix, U, mix

NAME = "op10_suffix_dedup"
WINDOW = 200
#: Prefix lengths of the rounds; the last is the window.
LENGTHS = (40, 160, 194, 200)


def blocks(prefix: Prefix, origin: np.ndarray, packed: np.ndarray, length: int, window: int) -> tuple[np.ndarray, ...]:
    """Blocks of one round: index of the run each comes from, rank, fingerprint of the block's bytes, and
    the block as a packed run.  Blocks are cut at fixed distances from the anchor, so equal positions of
    different texts fall into equal blocks."""
    width = window - length + 1
    first, place, size = unpack(packed)
    low, high = place - size + 1, place
    number = high // width - low // width + 1
    which = np.repeat(np.arange(len(packed)), number)
    b = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number) + (low // width)[which]
    low, high = np.maximum(b * width, low[which]), np.minimum(b * width + width - 1, high[which])
    anchor = (first + place)[which]
    at = origin[which] + anchor
    # the bytes that all strings of the whole block share, named by the pair of its halves
    begin, half = at - b * width, (length + 1) // 2
    rank = mix(prefix.ranges(begin, begin + half) * U(3) ^ prefix.ranges(begin + length - half, begin + length))
    shape = mix((low << 16 | high).astype(np.uint64))
    body = mix(prefix.ranges(at - high, at - low + window) ^ shape)
    return which, rank, body, pack(anchor - high, high, high - low + 1)


def ranked(joined: DataFrame, text: int, length: int, window: int) -> DataFrame:
    """(rank, position) pairs of a round: ``rank, body, rid, run``; the sign bit of ``run`` is handed on."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for ids, packed, origin, values in batched_runs(batch, text, octets):
            which, rank, body, block = blocks(Prefix(values), origin, packed, length, window)
            block |= packed[which] & np.int64(-1 << 63)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rank.view(np.int64)), pa.array(body.view(np.int64)), pa.array(ids[which]), pa.array(block)],
                names=["rank", "body", "rid", "run"])

    return arrow_map(joined, run, "rank bigint, body bigint, rid bigint, run bigint")


def rerank(pairs: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Positions that repeat, and the blocks to split in the next round."""
    keys = ["rank", "body"] if last else ["rank"]
    counted = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("least"),
                                       F.min("body").alias("lo"), F.max("body").alias("hi")) if not last else \
        pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("least"))
    alive = counted.where("n > 1 OR least < 0")
    alive = alive.select(*keys) if last else alive.select("rank", (F.col("lo") == F.col("hi")).alias("uniform"))
    left = pairs.join(written(alive, "ranks"), keys)
    if last:
        return left.where("run >= 0").select("rid", "run"), None
    # written, so that the next round does not do this one again
    left = written(left.select("uniform", "rid", "run"), "alive")
    return left.where("uniform AND run >= 0").select("rid", "run"), left.where("NOT uniform").select("rid", "run")


def repeats(docs: DataFrame, at: str, window: int = WINDOW, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """``rid`` and ``run``: runs of positions whose ``window`` bytes occur elsewhere too, of the texts in
    column ``at`` of ``docs``, whose first column is the row key ``rid``.  Runs may overlap."""
    if lengths[-1] != window or list(lengths) != sorted(set(lengths)):
        raise ValueError("lengths must grow up to the window")
    found, active = repeat_contexts(written(shared_anchors(anchor_rows(docs, octets, window, lengths[0], "rid", at)), "positions"))
    for length in lengths[1:]:
        pairs = ranked(with_runs(docs, active), docs.columns.index(at), length, window)
        more, active = rerank(pairs, length == window)
        found = found.unionByName(more)
    return found


def deduplicate(docs: DataFrame, window: int = WINDOW, lengths: Sequence[int] = LENGTHS, text: str = "text",
                id_col: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` plus ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs as
    ``[first byte, end)``) and ``kept`` (the bytes left, binary)."""
    columns = list(docs.columns)
    names = [f"c{i}" for i in range(len(columns))]
    at = columns.index(text)
    plain = docs.toDF(*names).select(row_key(f"c{columns.index(id_col)}", f"c{at}").alias("rid"), *names)
    joined = with_runs(plain, repeats(plain, f"c{at}", window, lengths), "left")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[1:-1])
    added = ["n_bytes", "n_removed", "spans", "kept"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buf, offsets = flat(batch.column(at + 1))
        lists = batch.column(batch.num_columns - 1)
        removed, spans, kept = [], [], []
        for i in range(batch.num_rows):
            raw = buf[offsets[i]:offsets[i + 1]]
            begin = end = np.zeros(0, np.int64)
            if lists[i].is_valid:
                first, _, size = unpack(np.asarray(lists[i].values, dtype=np.int64))
                begin, end = merge_ranges(first, first + size + window - 1)
            removed.append(int((end - begin).sum()))
            spans.append([{"first": int(a), "end": int(b)} for a, b in zip(begin, end)])
            cuts = np.concatenate([[0], np.stack([begin, end], 1).ravel(), [len(raw)]]).reshape(-1, 2)
            kept.append(b"".join(raw[a:b].tobytes() for a, b in cuts))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:-1], pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            names=[*names, *added])

    out = arrow_map(joined, run, f"{kinds}, n_bytes bigint, n_removed bigint, spans array<struct<first:bigint,end:bigint>>, kept binary")
    return out.toDF(*columns, *added)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents left after the repeated 200-byte strings are removed."""
    done = deduplicate(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2(F.col("kept"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (SELECT rid, i, md5(x[2 * i + 1:2 * i + 400]) AS h FROM (SELECT rid, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM d)),
t AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
s AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER w + 200 THEN 0 ELSE 1 END AS new FROM g JOIN t USING (h) WINDOW w AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, min(i) AS a, max(i) + 200 AS b FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM s) GROUP BY rid, k),
n AS (SELECT rid, list({'a': a, 'b': b} ORDER BY a) AS l, sum(b - a) AS n, count(*) AS c FROM r GROUP BY rid),
p AS (SELECT rid, doc_id, x, coalesce(n.n, 0) AS n, coalesce(n.c, 0) AS c,
             list_concat([0], coalesce(list_transform(l, lambda e: e.b), [])) AS froms,
             list_concat(coalesce(list_transform(l, lambda e: e.a), []), [length(x) // 2]) AS tos FROM d LEFT JOIN n USING (rid))
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, n::BIGINT AS n_removed, c::BIGINT AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(froms) + 1), lambda j: substr(x, 2 * froms[j] + 1, 2 * (tos[j] - froms[j]))), ''))) AS kept_sha256
FROM p
"""
