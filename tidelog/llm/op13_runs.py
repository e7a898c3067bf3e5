"""Periodic runs of words by a suffix automaton with link-cut access.

A *run* is a stretch of words with smallest period ``q`` and a length of at least ``max(24, 3 q)`` that no
neighbouring word extends keeping the period.

**Automaton.**  The words of a stretch are read into a suffix automaton; its suffix links form a tree in
which the path from a prefix's state to the root holds all suffixes of the prefix.  The words are then
appended once more: each *access* recolours the path of the new prefix with its end.  Link-cut trees
(splay trees over preferred paths) give the path in segments of one old colour: a segment with colour
``j`` and longest string ``L`` says that the longest string that ended last at ``j`` and ends now at
``i`` has ``L`` words.  Where ``p = i - j <= L`` that is a square of period ``p``, periodic back to word
``i - p - L + 1``; ``p`` is the smallest period, since a smaller one would have a later ``j``.  Squares with
one start and period are one run, and its end is the last ``i`` that gives it.  Recolouring is amortised
logarithmic, so a text of one repeated word costs no more than others.

**Stretches.**  In a run every ``GRAM`` consecutive words occur again inside the run (a period further on or
back), so only stretches in which each ``GRAM`` words do so can hold one.  They are found by fingerprints
for a whole batch, again inside what is left until nothing changes; no run is lost, and prose that does
not repeat builds no automaton.

**Scale.**  One scan, nothing shuffled; a task holds a batch of texts and one stretch's automaton (about
0.6 KB a word of the stretch).  Words of a stretch are compared as bytes; fingerprints only choose
stretches.

Defined cases: a null text has no words and no runs; empty texts and texts under 24 words have none; rows
that repeat are texts of their own; other columns pass unchanged, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, documents, flat, groups
from .rolling import Prefix, U, mix, word_bounds, word_prints

NAME = "op13_periodic_runs"
SQL = None
LEAST = 24
REPEATS = 3
#: Consecutive words that occur again inside every run: ``2 q + GRAM <= max(LEAST, REPEATS q)`` for all q.
GRAM = 8


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton of a sequence: suffix links, longest lengths, and the state of each prefix.  State 0
    is the root."""
    follow, link, length, ends, last = [{}], [-1], [0], [], 0
    for w in words:
        state = len(length)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and w not in follow[at]:
            follow[at][w] = state
            at = link[at]
        if at != -1:
            to = follow[at][w]
            if length[to] == length[at] + 1:
                link[state] = to
            else:
                copy = len(length)
                follow.append(dict(follow[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at != -1 and follow[at].get(w) == to:
                    follow[at][w] = copy
                    at = link[at]
                link[to] = link[state] = copy
        ends.append(state)
        last = state
    return link, length, ends


class Paths:
    """Link-cut trees over a fixed tree (parent 0: none) whose accesses colour the path to the root."""

    def __init__(self, parent: list[int]):
        self.up = list(parent)
        self.left, self.right = [0] * len(parent), [0] * len(parent)
        #: Colour of a preferred path, at the root of its splay tree.
        self.colour = [-1] * len(parent)

    def _splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour

        def rotate(x: int, p: int, top: bool) -> None:
            g = up[p]
            if left[p] == x:
                inner = left[p] = right[x]
                right[x] = p
            else:
                inner = right[p] = left[x]
                left[x] = p
            if inner:
                up[inner] = p
            up[p], up[x] = x, g
            if top:
                colour[x] = colour[p]
            elif left[g] == p:
                left[g] = x
            else:
                right[g] = x

        while True:
            p = up[x]
            if not p or left[p] != x and right[p] != x:
                return
            g = up[p]
            if not g or left[g] != p and right[g] != p:
                rotate(x, p, True)
                return
            over = up[g]
            top = not over or left[over] != g and right[over] != g
            if (left[p] == x) == (left[g] == p):
                rotate(p, g, top)
                rotate(x, p, top)
            else:
                rotate(x, p, False)
                rotate(x, g, top)

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Colours the path from ``x`` to the root; gives its old segments from below: old colour and lowest
        node, uncoloured ones left out."""
        up, right, held, out, below = self.up, self.right, self.colour, [], 0
        while x:
            self._splay(x)
            if right[x]:
                held[right[x]] = held[x]
            right[x] = below
            if held[x] >= 0:
                out.append((held[x], x))
            below, x = x, up[x]
        held[below] = colour
        return out


def runs_of(words: list[int], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of a sequence, by start, then period."""
    link, length, ends = automaton(words)
    link[0] = 0
    paths, found = Paths(link), {}
    for i, state in enumerate(ends):
        for j, node in paths.access(state, i):
            p, most = i - j, length[node]
            if p <= most:
                found[i - p - most + 1, p] = i
    return sorted((s, e - s + 1, p) for (s, p), e in found.items() if e - s + 1 >= max(least, repeats * p))


def stretches(prints: np.ndarray, first: np.ndarray, gram: int = GRAM, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ``[a, b)`` of words, none across texts, in which each ``gram`` words occur twice, and which
    have ``least`` words; ``first`` has each text's first word and the total."""
    grams = Prefix(prints).windows(gram)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:len(grams)] == text[gram - 1:]) if len(grams) else np.zeros(0, np.int64)
    part = text[at]
    while len(at):
        key = mix(grams[at] ^ mix(part.astype(np.uint64) + U(1)))
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:]] = same
        again[order[:-1]] |= same
        new = np.append(True, (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1]) | ~again[:-1])
        part = np.cumsum(new) - 1
        keep = again & (np.bincount(part)[part] >= least - gram + 1)
        if keep.all():
            begin = np.flatnonzero(new)
            return at[begin], at[np.append(begin[1:], len(at)) - 1] + gram
        at, part = at[keep], part[keep]
    return at, at


def numbered(words: list[bytes]) -> list[int]:
    seen: dict[bytes, int] = {}
    return [seen.setdefault(w, len(seen)) for w in words]


def find_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``runs`` (``start, length, period`` by start, then period)
    and ``collapsed``: the words that no run contains after its first ``period`` words, joined by one space."""
    gram = least // repeats
    if repeats < 2 or gram < 1:
        raise ValueError("runs need two repeats and a word each at least")
    columns = list(docs.columns)
    names = [f"c{i}" for i in range(len(columns))]
    at = columns.index(text)
    plain = docs.toDF(*names)
    kinds = "".join(f"`{n}` {f.dataType.simpleString()}, " for n, f in zip(names, plain.schema.fields))
    added = ["n_words", "runs", "collapsed"]

    def one(raw: bytes, where: list[tuple[int, int]]):
        words, found = raw.split(), []
        for a, b in where:
            found += [(s + a, n, p) for s, n, p in runs_of(numbered(words[a:b]), least, repeats)]
        found.sort(key=lambda r: (r[0], r[2]))
        if found:
            keep = np.ones(len(words), dtype=bool)
            for s, n, p in found:
                keep[s + p:s + n] = False
            words = [words[i] for i in np.flatnonzero(keep).tolist()]
        return found, b" ".join(words)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buf, offsets = flat(batch.column(at))
        for i, j in groups(offsets):
            part, bounds = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            start, end, first = word_bounds(part, bounds)
            begin, stop = stretches(word_prints(part, start, end), first, gram, least)
            owner = np.searchsorted(first, begin, side="right") - 1
            where: dict[int, list[tuple[int, int]]] = {}
            for o, a, b in zip(owner.tolist(), (begin - first[owner]).tolist(), (stop - first[owner]).tolist()):
                where.setdefault(o, []).append((a, b))
            done = [one(part[bounds[k]:bounds[k + 1]].tobytes(), where.get(k, ())) for k in range(j - i)]
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(i, j - i) for c in batch.columns), pa.array(np.diff(first), pa.int64()),
                 pa.array([[{"start": s, "length": n, "period": p} for s, n, p in found] for found, _ in done],
                          pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                 pa.array([left.decode() for _, left in done], pa.string())],
                names=[*names, *added])

    out = arrow_map(plain, run, f"{kinds}n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.toDF(*columns, *added)


def with_loop(text: Column, doc_id: Column) -> Column:
    """The query's input: in texts whose id has a checksum ``h`` that ends in 0, the words from ``g mod n``
    on repeat the ``p`` words there (``g = h div 10``); other texts, and rows without id, as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = F.pmod(g, n.cast("bigint")).cast("int")
    p = (F.lit(1) + F.call_function("div", n - a, F.lit(3) + g % 8)).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    looped = F.array_join(F.slice(F.concat(F.slice(words, 1, a), loop), 1, n), " ")
    return F.when((h % 10 == 0) & (n > 0), looped).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents; a tenth of them is given a loop of its own words first."""
    docs = documents(spark, sf_dir).select("doc_id", with_loop(F.col("text"), F.col("doc_id")).alias("text"))
    best = F.expr("""array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period <> y.length * x.period THEN IF(x.length * y.period > y.length * x.period, -1, 1)
        WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1) ELSE IF(x.period < y.period, -1, IF(x.period > y.period, 1, 0)) END)""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return find_runs(docs).withColumn("best", F.get(best, F.lit(0))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.call_function("div", F.lit(1000) * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
