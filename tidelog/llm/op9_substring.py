"""Substring dedup by seed and extend.

Seeds are winnowed anchors (``llm/anchors.py``): equal windows always share a seed at the same place.
Documents are joined on their seeds, and every shared seed is extended both ways over the windows that
hold it:

* all occurrences of the seed have one context - the extension reaches both ends of every window, the
  whole run is a repeat;
* two or more occurrences share a context - the same for those;
* other contexts differ somewhere: one representative of each context extends its seed window by
  window, left and right, and the windows that occur in two contexts are repeats.

Copies therefore never meet pair by pair: a group of any size is one context with a count.  Repeated
windows that overlap or touch are merged to maximal repeats and removed from the text.

Scale: the seed rows are counted by a partial aggregate and joined by the planner (adaptive skew
splitting), the counted side of every join being a written table; texts are dealt by row key for the window
step and again for the removal.  The rows of shared seeds are written once to the checkpoint folder.  Contexts
and windows are compared by 128 bits (two 64-bit fingerprints).

Defined cases: a null text has no words; a text shorter than the window keeps all its words; rows that
repeat (same id and text) are separate documents, so each is a repeat of the other; null ids stay
null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import anchor_rows, batched_runs, merge_ranges, pack, repeat_contexts, shared_anchors, unpack, with_runs, words
from .base import arrow_map, documents, flat, row_key, written
from .rolling import Prefix, U, mix, word_bounds

NAME = "op9_substring_dedup"
WINDOW = 35
SEED = 10


def repeats(docs: DataFrame, at: str, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``rid`` and ``run``: runs of repeated windows of the texts in column ``at`` of ``docs``, whose first
    column is the row key ``rid``.  Runs of one text may overlap."""
    whole, ones = repeat_contexts(written(shared_anchors(anchor_rows(docs, words, window, seed, "rid", at)), "seeds"))
    extended = _extend(with_runs(docs, ones), docs.columns.index(at), window)
    twice = extended.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("least"))
    twice = written(twice.where("n > 1 OR least < 0").select("w1", "w2"), "windows")
    single = extended.where("run >= 0").join(twice, ["w1", "w2"]).select("rid", "run")
    return whole.unionByName(single)


def _extend(joined: DataFrame, text: int, window: int) -> DataFrame:
    """Every window of the given runs as a run of one window, with two independent fingerprints."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for ids, packed, origin, values in batched_runs(batch, text, words):
            first, _, size = unpack(packed)
            which = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]
            begin = at + origin[which]
            w1 = Prefix(values).ranges(begin, begin + window)
            w2 = Prefix(mix(values ^ U(0x5851F42D4C957F2D))).ranges(begin, begin + window)
            one = pack(at, np.zeros_like(at), np.ones_like(at)) | packed[which] & np.int64(-1 << 63)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(ids[which]), pa.array(one)],
                names=["w1", "w2", "rid", "run"])

    return arrow_map(joined, run, "w1 bigint, w2 bigint, rid bigint, run bigint")


def maximal(packed: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal repeats (first symbol, end) from runs of repeated windows."""
    first, _, size = unpack(packed)
    return merge_ranges(first, first + size + window - 1)


def deduplicate(docs: DataFrame, window: int = WINDOW, seed: int = SEED, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``n_removed``, ``spans`` (maximal repeats as
    ``[first word, end)``) and ``kept`` (the words left, joined by one space)."""
    columns = list(docs.columns)
    names = [f"c{i}" for i in range(len(columns))]
    at = columns.index(text)
    plain = docs.toDF(*names).select(row_key(f"c{columns.index(id_col)}", f"c{at}").alias("rid"), *names)
    joined = with_runs(plain, repeats(plain, f"c{at}", window, seed), "left")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[1:-1])
    added = ["n_words", "n_removed", "spans", "kept"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buf, offsets = flat(batch.column(at + 1))
        lists = batch.column(batch.num_columns - 1)
        counts, removed, spans, kept = [], [], [], []
        for i in range(batch.num_rows):
            part = buf[offsets[i]:offsets[i + 1]]
            start, end, _ = word_bounds(part, np.array([0, len(part)]))
            begin, stop = maximal(np.asarray(lists[i].values if lists[i].is_valid else [], dtype=np.int64), window)
            keep = np.ones(len(start), dtype=bool)
            for a, b in zip(begin, stop):
                keep[a:b] = False
            raw = part.tobytes()
            counts.append(len(start))
            removed.append(int((stop - begin).sum()))
            spans.append([{"first": int(a), "end": int(b)} for a, b in zip(begin, stop)])
            kept.append(b" ".join(raw[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist())).decode())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:-1], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())],
            names=[*names, *added])

    out = arrow_map(joined, run, f"{kinds}, n_words bigint, n_removed bigint, spans array<struct<first:bigint,end:bigint>>, kept string")
    return out.toDF(*columns, *added)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after the repeats of 35 words and more are removed."""
    done = deduplicate(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
t AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT rid, i + k AS p FROM g JOIN t USING (h), (SELECT unnest(range(0, 35)) AS k)),
r AS (SELECT rid, list(p) AS ps, count(*) AS n FROM c GROUP BY rid),
k AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS kept FROM (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d)
      ANTI JOIN c USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (rid) LEFT JOIN k USING (rid)
"""
