"""Winnowed anchors of whole texts as a Spark table.

A *window* is ``window`` consecutive symbols of one text.  Every window has one anchor: of its grams
(``gram`` symbols) the one with the smallest fingerprint.  Neighbouring windows mostly share their
anchor; each maximal group of windows with one anchor is a *run* and gives one row:

``anchor``   fingerprint of the gram: equal windows have equal anchors at equal places
``context``  fingerprint of all symbols that the run's windows cover, with the anchor's place in it
``rid``      the text's row key
``run``      the run's first window, the anchor's place in it and its number of windows, in one long

Equal windows therefore always meet under one ``anchor``, although only about ``2 / (window - gram)``
of the positions give a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, flat, groups, written
from .rolling import BYTE_VALUES, Prefix, U, mix, winnow, word_bounds, word_prints

#: Window starts handled at once; a longer text is cut into overlapping pieces.
PIECE = 1 << 21

#: Layout of ``run``: first window, anchor's place, number of windows.
FIRST, PLACE, BITS = 32, 16, (1 << 16) - 1


def pack(first: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << FIRST | place.astype(np.int64) << PLACE | size.astype(np.int64)


def unpack(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, anchor's place and number of windows; the sign bit is not part of them."""
    return run >> FIRST & 0x7FFFFFFF, run >> PLACE & BITS, run & BITS


Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols are the fingerprints of words ``[^\\x20\\x09-\\x0D]+``."""
    start, end, first = word_bounds(buf, offsets)
    return word_prints(buf, start, end), first


def octets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols are the UTF-8 bytes."""
    return BYTE_VALUES[buf], offsets


def runs(values: np.ndarray, first: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of a batch: text index, packed run, anchor and context."""
    if window > BITS:
        raise ValueError("windows must be shorter than 2**16 symbols")
    total = len(values)
    lengths = np.diff(first)
    for lo in range(0, max(total - window + 1, 0), PIECE):
        hi = min(lo + PIECE, total - window + 1)
        prefix = Prefix(values[lo:hi + window - 1])
        grams = prefix.windows(gram)
        chosen = winnow(grams, window - gram + 1)
        text = np.repeat(np.arange(len(lengths)), lengths)[lo:hi + window - 1] if lo or hi + window - 1 < total else \
            np.repeat(np.arange(len(lengths)), lengths)
        at = np.flatnonzero(text[:hi - lo] == text[window - 1:])
        if not len(at):
            continue
        chosen = chosen[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        begins, ends = at[begin], at[np.append(begin[1:], len(at)) - 1] + 1
        anchor_at = chosen[begin]
        owner = text[begins]
        run = pack(begins + lo - first[owner], anchor_at - begins, ends - begins)
        shape = mix((run & ((1 << FIRST) - 1)).astype(np.uint64))
        yield owner, run, grams[anchor_at], mix(prefix.ranges(begins, ends + window - 1) ^ shape)


def anchor_rows(docs: DataFrame, symbols: Symbols, window: int, gram: int, rid: str = "rid", text: str = "text") -> DataFrame:
    """One row per run of each text of ``docs``: ``anchor, context, rid, run``."""
    source = docs.select(rid, text)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        buf, offsets = flat(batch.column(1))
        for i, j in groups(offsets):
            values, bounds = symbols(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for owner, where, anchor, context in runs(values, bounds, window, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(ids[i + owner]), pa.array(where)],
                    names=["anchor", "context", "rid", "run"])

    return arrow_map(source, run, "anchor bigint, context bigint, rid bigint, run bigint")


def shared_anchors(rows: DataFrame) -> DataFrame:
    """Rows whose anchor occurs twice or more, with ``uniform``: all its occurrences have one context.

    The count is a partial aggregate.  Its result is written before the join, so that both sides of the
    join are plain shuffles: adaptive execution can then split an anchor that has any share of all rows.
    """
    counted = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("__n"), F.min("context").alias("__lo"), F.max("context").alias("__hi"))
    often = written(counted.where("__n > 1").select("anchor", (F.col("__lo") == F.col("__hi")).alias("uniform")), "anchors")
    return rows.join(often, "anchor")


def merge_ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as maximal ranges in order."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), dtype=bool)
    new[1:] = begin[1:] > reach[:-1]
    start = np.flatnonzero(new)
    return begin[start], reach[np.append(start[1:], len(begin)) - 1]


def repeat_contexts(seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From :func:`shared_anchors`: the runs (``rid, run``) whose context occurs twice or more, which are
    repeats as a whole; and, for anchors with several contexts, one run of each context (``rid, run``)
    with the sign bit of ``run`` set where the context occurs twice or more."""
    mixed = seeds.where(~F.col("uniform"))
    contexts = mixed.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "run")).alias("one"))
    many = written(contexts.where("n > 1").select("anchor", "context"), "contexts")
    whole = seeds.where("uniform").select("rid", "run").unionByName(mixed.join(many, ["anchor", "context"]).select("rid", "run"))
    sign = F.when(F.col("n") > 1, F.lit(-(1 << 63)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return whole, contexts.select(F.col("one.rid").alias("rid"), F.col("one.run").bitwiseOR(sign).alias("run"))


def with_runs(docs: DataFrame, runs_of: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` joined by ``rid`` with the list of its runs.  Rows that repeat share ``rid`` and give their
    runs once, by a partial aggregate, so a list is bounded by its text's length.  All columns of ``docs``
    stay, so that every such join of a plan reads the same exchange of the texts."""
    return docs.join(runs_of.groupBy("rid").agg(F.collect_set("run").alias("runs")), "rid", how)


def batched_runs(batch: pa.RecordBatch, text: int, symbols: Symbols, rid: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups of texts of a batch whose last column is the list of runs: row key per run, packed runs,
    index of the run's text's first symbol, and the symbols of the group."""
    ids = batch.column(rid).to_numpy(zero_copy_only=False)
    buf, offsets = flat(batch.column(text))
    lists = batch.column(batch.num_columns - 1)
    bounds = lists.offsets.to_numpy()
    packed = lists.values.to_numpy(zero_copy_only=False)
    for i, j in groups(offsets):
        values, first = symbols(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        owner = np.repeat(np.arange(j - i), np.diff(bounds[i:j + 1]))
        yield ids[i:j][owner], packed[bounds[i]:bounds[j]], first[owner], values
