"""LM scoring with the arcs and failure weights of a backoff model.

**Model.**  Tokens are lower-cased words and one end for each text.  The root distribution is the
smoothed unigram ``(c + a) / (N + a (V + 1))``.  Longer n-grams are smoothed by interpolated absolute
discounting, ``p(w | h) = (c(hw) - D) / c(h) + b(h) p(w | h')``, with ``b(h)`` the mass that the kept
arcs leave; every distribution sums to one.

**Backoff.**  Every kept n-gram is an arc, every kept history a state with a failure weight ``b(h)``.  The
traversal of an automaton is not carried out: all tokens of a group of texts are read at once, one length
of n-grams after the other from the shortest, and each length adds its arcs and the failure weights of the
histories before it.  The result is that of following failure arcs from the longest kept history.

**Scale.**  An n-gram is kept if it occurs ``MIN_COUNT`` times, whatever the size of the corpus, so the
model grows with the input and no task or driver holds it.  Keys are 64-bit fingerprints, dealt into
parts by their high bits; a part has the keys of about ``PART_BYTES`` of text.  Counts are packed by part
in the tasks, added up for each part and written, with what each history's arcs take.  Texts are dealt
into blocks; each block asks the parts for its distinct n-grams and gets the counts and failure weights
of those that exist, beside which its texts are read.  A key has at most one row in each block, however
often it occurs.  Counting takes ``COUNT_ROUNDS`` jobs, each over all texts and a range of the keys, and scoring
``SCORE_ROUNDS``, each over some of the blocks: the shuffle files of one are deleted before the next.  The
arcs with at least ``1 / ARCS`` of the training tokens (at most ``ARCS`` of each length) are broadcast as a
cache, so that blocks need not ask for them; results do not depend on it.

Defined cases: a null text has the end as its only token; a null id reads as the empty text in the
fold rule; rows that repeat are texts of their own; without training texts every token has the
probability of an unseen one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents, flat, give_back, groups, row_key, ship, written
from .rolling import U, fold_ascii, mix, word_bounds, word_prints

NAME = "op6_lm_scoring"
SQL = None
ARCS = 1 << 20
ORDER = 3
MIN_COUNT = 2
DISCOUNT = 0.75
ADDED = 0.1
BLOCK_BYTES = 8 << 20
PART_BYTES = 2 << 20
#: Jobs in which n-grams are counted (each a range of keys) and texts are scored (each some blocks).
COUNT_ROUNDS, SCORE_ROUNDS = 2, 4
#: Entries a task holds before they are packed and sent.
HELD = 1 << 21
#: Fingerprint of the end token, and a salt for each further length of n-grams.
END = int(mix(np.array([0x5EED0E9D], dtype=np.uint64))[0])
SALT, ODD = (U(0xA24BAED4963EE407), U(0x9FB21C651E98DF25)), U(0xD6E8FEB86659FD93)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token fingerprints of the texts, each with its end, and each text's first token."""
    start, end, first = word_bounds(buf, offsets)
    words = word_prints(fold_ascii(buf), start, end)
    return np.insert(words, first[1:], U(END)), first + np.arange(len(first))


def _batches(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buf, offsets = flat(column)
    for i, j in groups(offsets):
        yield i, j, *tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def each_once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, an index of each and how often it occurs (``np.unique`` sorts stably, twice as long)."""
    by = np.argsort(keys)
    keys = keys[by]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else by
    return keys[begin], by[begin], np.diff(np.append(begin, len(keys)))


def grams(words: np.ndarray, first: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length the keys of the n-grams that end at each token, and whether one does (none crosses a
    text).  The key of its history is the shorter key at the token before."""
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    out = [(words, np.ones(len(words), dtype=bool))]
    for length in range(2, order + 1):
        key = np.zeros(len(words), dtype=np.uint64)
        key[1:] = mix((out[-1][0][:-1] + SALT[length - 2]) * ODD + words[1:])
        out.append((key, place >= length - 1))
    return out


def distinct_of(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys by a plain sort: faster than ``np.unique`` where most are distinct."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def planes(values: np.ndarray) -> bytes:
    """Values as planes of their bytes: what sorted keys share compresses.  Keys have all eight planes; numbers
    only those up to the largest one's, none for zeros."""
    wide = values.itemsize
    if values.dtype != np.uint64:
        wide = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return values.view(np.uint8).reshape(-1, values.itemsize)[:, :wide].T.tobytes()


def keys_of(data: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(data.as_buffer(), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(np.uint64)


def numbers_of(data: pa.Scalar, n: int, kind=np.int64) -> np.ndarray:
    """The ``n`` numbers beside as many keys."""
    grid = np.zeros((n, np.dtype(kind).itemsize), dtype=np.uint8)
    if n:
        raw = np.frombuffer(data.as_buffer(), dtype=np.uint8).reshape(-1, n)
        grid[:, :len(raw)] = raw.T
    return grid.reshape(-1).view(kind)


def merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, their length and history (a key has one of each), the sum of their counts.  ``held`` is
    emptied: its rows need not stay beside the sorted ones."""
    keys, length, history, n = (np.concatenate(c) for c in zip(*held))
    held.clear()
    by = np.argsort(keys)
    keys = keys[by]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else by
    n = np.add.reduceat(n[by], begin) if len(keys) else n
    by = by[begin]
    return keys[begin], length[by], history[by], n


def by_part(parts: int, keys: np.ndarray, *columns: np.ndarray, **fixed: int) -> Iterator[pa.RecordBatch]:
    """Rows ``part``, the ``fixed`` numbers, and the slices of sorted keys and their columns as planes."""
    of = ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(of)) + 1
    bounds = [0, *cut.tolist(), len(keys)]
    for k in range(0, len(bounds) - 1, 32):
        some = [(a, b) for a, b in zip(bounds[k:k + 32], bounds[k + 1:k + 33]) if a < b]
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(of[a]) for a, _ in some], pa.int64()), *(pa.array([v] * len(some), pa.int64()) for v in fixed.values()),
                 *(pa.array([planes(c[a:b]) for a, b in some], pa.binary()) for c in (keys, *columns))],
                names=["part", *fixed, *(f"c{i}" for i in range(len(columns) + 1))])


def dealt(rows: DataFrame, n: int, by: str, *then: str) -> DataFrame:
    return rows.repartition(n, by).sortWithinPartitions(by, *then)


def whole_parts(batches, start, each, end):
    """Rows in order of their first column: ``start()`` a state, ``each(state, batch, row)``, ``end(part, state)``."""
    now, state = None, None
    for batch in batches:
        for i, part in enumerate(batch.column(0).to_pylist()):
            if part != now:
                if now is not None:
                    yield from end(now, state)
                now, state = part, start()
            yield from each(state, batch, i) or ()
    if now is not None:
        yield from end(now, state)
    state = None
    give_back()


class Model:
    """What every task gets: the totals, the threshold, and the cache of frequent n-grams (of each length
    sorted keys with their counts, and count and number of the arcs that leave them)."""

    def __init__(self, total: int, distinct: int, least: int, order: int):
        self.total, self.distinct, self.least, self.order = total, distinct, least, order
        self.keys = [np.zeros(0, np.uint64)] * order
        self.rest = [(np.zeros(0, np.int64),) * 3] * order

    def root(self, n: np.ndarray) -> np.ndarray:
        return (n + ADDED) / (self.total + ADDED * (self.distinct + 1))

    def log_scores(self, words: np.ndarray, first: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: whether it is known, and the log10 probabilities of the root and of the automaton;
        ``table`` has the sorted keys and the counts of the n-grams that are not in the cache."""
        p = history = None
        for length, (key, whole) in enumerate(grams(words, first, self.order)):
            n, sent, arcs = (np.zeros(len(words), dtype=np.int64) for _ in range(3))
            # looked up in their order, which stays in the CPU's cache
            by = np.argsort(key)
            key, ok = key[by], whole[by]
            for keys, rest in ((self.keys[length], self.rest[length]), (table[0], table[1:])):
                at = find(keys, key)
                hit = ok & (at >= 0)
                for column, value in zip((n, sent, arcs), rest):
                    column[by[hit]] = value[at[hit]]
            if p is None:
                known, p = n > 0, self.root(n)
                base = np.log10(p)
            else:
                # states whose history is kept; without an arc only the failure weight counts
                at = np.flatnonzero(whole[1:] & (history[0][:-1] >= self.least)) + 1
                below = history[0][at - 1]
                left = 1.0 - (history[1][at - 1] - DISCOUNT * history[2][at - 1]) / below
                p[at] = np.where(n[at] >= self.least, n[at] - DISCOUNT, 0.0) / below + left * p[at]
            history = n, sent, arcs
        return known, base, np.log10(p)


def train(docs: DataFrame, text: str = "text", arcs: int | None = None, order: int = ORDER, min_count: int = MIN_COUNT) -> tuple[Model, DataFrame]:
    """The model of all texts of ``docs``: totals with the cache, and the written table of all words and
    kept n-grams by part.  With ``arcs`` only n-grams with ``1 / arcs`` of the tokens are kept."""
    if not 1 <= order <= 3:
        raise ValueError("order 1 to 3")
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # whole parts in each round
    parts = COUNT_ROUNDS * max(1, -(-size // (COUNT_ROUNDS * PART_BYTES)))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 26)

    def count(batches, turn):
        held, entries = [], 0
        for batch in batches:
            for _, _, words, first in _batches(batch.column(0)):
                shorter = np.zeros(len(words), dtype=np.uint64)
                for length, (key, ok) in enumerate(grams(words, first, order), 1):
                    ok &= (key >> U(32)) * U(COUNT_ROUNDS) >> U(32) == turn
                    keys, at, times = each_once(key[ok])
                    held.append((keys, np.full(len(keys), length, dtype=np.uint8), shorter[ok][at], times))
                    entries += len(keys)
                    shorter = np.append(U(0), key[:-1])
                if entries > HELD:
                    held = [merged(held)]
                    entries = len(held[0][0])
                    if entries > HELD // 2:
                        yield from by_part(parts, *held[0])
                        held, entries = [], 0
        if held:
            yield from by_part(parts, *merged(held))
        held = []
        give_back()

    def gather(state, batch, i):
        keys = keys_of(batch.column(1)[i])
        state.append((keys, numbers_of(batch.column(2)[i], len(keys), np.uint8), keys_of(batch.column(3)[i]), numbers_of(batch.column(4)[i], len(keys))))

    def add_up(part, state):
        keys, length, history, times = merged(state)
        keep = (length == 1) | (times >= min_count)
        one = length == 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([int(times[one].sum())]), pa.array([int(one.sum())]),
             *(pa.array([planes(c[keep])], pa.binary()) for c in (keys, length, history, times))],
            names=["part", "total", "words", "c0", "c1", "c2", "c3"])

    columns = "c0 binary, c1 binary, c2 binary, c3 binary"

    def counted_in(turn):
        packed = docs.select(text).mapInArrow(lambda b: count(b, turn), f"part bigint, {columns}")
        return written(dealt(packed, n, "part").mapInArrow(lambda b: whole_parts(b, list, gather, add_up),
                                                           f"part bigint, total bigint, words bigint, {columns}"), "grams")

    counted = reduce(DataFrame.unionByName, [counted_in(turn) for turn in range(COUNT_ROUNDS)])
    total, distinct = counted.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    least = max(min_count, -(-total // arcs) if arcs else 0)

    def leaving(batches):
        """Of each history: count and number of its kept arcs."""
        for batch in batches:
            for i in range(batch.num_rows):
                history = keys_of(batch.column(1)[i])
                length, times = numbers_of(batch.column(0)[i], len(history), np.uint8), numbers_of(batch.column(2)[i], len(history))
                kept = (length > 1) & (times >= least)
                states, which = np.unique(history[kept], return_inverse=True)
                sent, number = np.zeros(len(states), dtype=np.int64), np.bincount(which, minlength=len(states)).astype(np.int64)
                np.add.at(sent, which, times[kept])
                yield from by_part(parts, states, sent, number, kind=1)
            give_back()

    def beside(state, batch, i):
        kind = batch.column(1)[i].as_py()
        keys = keys_of(batch.column(2)[i])
        state[kind].append((keys, numbers_of(batch.column(3)[i], len(keys), np.int64 if kind else np.uint8), numbers_of(batch.column(4)[i], len(keys))))

    def finish(part, state):
        keys, length, times = state[0][0]
        keep = (length == 1) | (times >= least)
        keys, length, times = keys[keep], length[keep], times[keep]
        sent, number = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        for states, s, a in state[1]:
            at = find(keys, states)
            sent[at] += s
            number[at] += a
        yield pa.RecordBatch.from_arrays([pa.array([part]), *(pa.array([planes(c)], pa.binary()) for c in (keys, length, times, sent, number))],
                                         names=["part", "c0", "c1", "c2", "c3", "c4"])

    both = counted.select("part", F.lit(0).cast("bigint").alias("kind"), "c0", "c1", F.col("c3").alias("c2")).unionByName(
        counted.select("c1", "c2", "c3").mapInArrow(leaving, "part bigint, kind bigint, c0 binary, c1 binary, c2 binary"))
    table = written(dealt(both, n, "part", "kind").mapInArrow(lambda b: whole_parts(b, lambda: ([], []), beside, finish),
                                                              f"part bigint, {columns}, c4 binary"), "arcs")
    model, often = Model(total, distinct, least, order), max(least, -(-total // ARCS))

    def frequent(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = keys_of(batch.column(1)[i]).view(np.int64)
                length, *rest = (numbers_of(batch.column(k)[i], len(keys), np.uint8 if k == 2 else np.int64) for k in range(2, 6))
                some = rest[0] >= often
                yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (keys, length.astype(np.int64), *rest)], names=["key", "length", "n", "sent", "arcs"])
            give_back()

    cache = table.mapInArrow(frequent, "key bigint, length bigint, n bigint, sent bigint, arcs bigint").toArrow()
    keys, lengths, *rest = (cache.column(k).to_numpy() for k in range(5))
    for length in range(order):
        at = np.flatnonzero(lengths == length + 1)
        at = at[np.argsort(keys[at].view(np.uint64))]
        model.keys[length], model.rest[length] = keys[at].view(np.uint64), tuple(c[at] for c in rest)
    model.parts = parts
    return model, table


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text", id_col: str = "doc_id",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (the root
    distribution alone) and ``score``."""
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # as many blocks in each round
    blocks = SCORE_ROUNDS * max(1, -(-size // (SCORE_ROUNDS * block_bytes)))
    every = docs.select(F.pmod(row_key(id_col, text), F.lit(blocks)).alias("block"), F.col(id_col).alias("doc_id"),
                        held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    kind = every.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 26)

    def ask(batches):
        m = shared.value
        now, held, entries = None, [], 0

        def asked():
            return by_part(m.parts, distinct_of(np.concatenate(held)), kind=1, block=now) if held else ()

        for batch in batches:
            block = batch.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if block[a] != now:
                    yield from asked()
                    now, held, entries = int(block[a]), [], 0
                for _, _, words, first in _batches(batch.column(1).slice(a, b - a)):
                    for length, (key, ok) in enumerate(grams(words, first, m.order)):
                        keys = distinct_of(key[ok])
                        held.append(keys[find(m.keys[length], keys) < 0])
                        entries += len(held[-1])
                    if entries > HELD:
                        held = [distinct_of(np.concatenate(held))]
                        entries = len(held[0]) // 2
        yield from asked()
        held = []
        give_back()

    def answer(batches):
        """Counts of the asked keys that exist; a part's table comes before what asks for it."""
        def each(state, batch, i):
            if not batch.column(1)[i].as_py():
                keys = keys_of(batch.column(3)[i])
                state += [keys] + [numbers_of(batch.column(k)[i], len(keys)) for k in (4, 5, 6)]
            elif state:
                at = find(state[0], keys_of(batch.column(3)[i]))
                at = at[at >= 0]
                if len(at):
                    yield pa.RecordBatch.from_arrays([batch.column(2).slice(i, 1), *(pa.array([planes(c[at])], pa.binary()) for c in state)],
                                                     names=["block", "c0", "c1", "c2", "c3"])

        yield from whole_parts(batches, list, each, lambda part, state: ())

    no_bytes, no_number = F.lit(None).cast("binary"), F.lit(0).cast("bigint")

    def beside(rows):
        texts = dealt(rows.select("block", "text"), n, "block")
        asks = texts.mapInArrow(ask, "part bigint, kind bigint, block bigint, c0 binary").select(
            "*", *(no_bytes.alias(f"c{k}") for k in (1, 2, 3)))
        there = counts.select("part", no_number.alias("kind"), no_number.alias("block"), "c0", F.col("c2").alias("c1"), F.col("c3").alias("c2"), F.col("c4").alias("c3"))
        answers = dealt(there.unionByName(asks), n, "part", "kind").mapInArrow(answer, "block bigint, c0 binary, c1 binary, c2 binary, c3 binary")
        answers = answers.select("block", F.lit(0).alias("kind"), "c0", "c1", "c2", "c3", F.lit(None).cast(kind).alias("doc_id"),
                                 F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("string").alias("text"))
        texts = rows.select("block", F.lit(1).alias("kind"), *(no_bytes.alias(f"c{k}") for k in range(4)), "doc_id", "held_out", "text")
        return dealt(answers.unionByName(texts), n, "block", "kind")

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def read(batches):
        m = shared.value
        now, held, table = None, [], None
        for batch in batches:
            block, is_text = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = np.flatnonzero((block[1:] != block[:-1]) | (is_text[1:] != is_text[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if block[a] != now:
                    now, held, table = block[a], [], None
                if not is_text[a]:
                    for i in range(a, b):
                        keys = keys_of(batch.column(2)[i])
                        held.append([keys] + [numbers_of(batch.column(k)[i], len(keys)) for k in (3, 4, 5)])
                    continue
                if table is None:
                    columns = [np.concatenate(c) for c in zip(*held)] if held else [np.zeros(0, np.uint64)] + [np.zeros(0, np.int64)] * 3
                    held = []
                    by = np.argsort(columns[0])
                    for k in range(4):
                        columns[k] = columns[k][by]
                    table, columns, by = columns, None, None
                yield scored(batch.slice(a, b - a), m, table)
        held, table = [], None
        give_back()

    def scored(part, m, table):
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for _, _, words, first in _batches(part.column(8)):
            known, base, logs = m.log_scores(words, first, table)
            out["n_tokens"] += np.diff(first).tolist()
            for name, values in (("n_known", known.astype(np.int64)), ("base_score", base), ("score", logs)):
                out[name] += np.add.reduceat(values, first[:-1]).tolist()
        size = part.num_rows
        return pa.RecordBatch.from_arrays(
            [part.column(6), part.column(7), pa.array(out["n_tokens"], pa.int64()), pa.array(out["n_known"], pa.int64()),
             pa.array(np.full(size, m.total, dtype=np.int64)), pa.array(out["base_score"], pa.float64()), pa.array(out["score"], pa.float64())],
            names=names)

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return reduce(DataFrame.unionByName, [
        written(beside(every.where(F.pmod("block", F.lit(SCORE_ROUNDS)) == r)).mapInArrow(read, schema), "scores") for r in range(SCORE_ROUNDS)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the model of those that are not held out."""
    docs = documents(spark, sf_dir)
    model, counts = train(docs.where(~held_out()))
    return score(docs, model, counts)
