"""N-gram Jaccard join with PartEnum signatures.

A text's set holds the 64-bit fingerprints of its distinct word shingles.  Equal sets form a *class*
and count once from there on.

**Signatures.**  Sizes are cut into bands; a set takes part in its own band's instance, and in the next
one's when a partner there can be similar enough.  In an instance whose sets have at most ``M``
elements, similar sets differ in at most ``k = floor(2 M (1 - s) / (1 + s))`` elements.  The feature
domain is partitioned by hash into more than ``k`` parts, so similar sets agree on some parts whole:

* small ``k``: ``k + 2`` parts, one signature for each pair of parts - two parts agree;
* larger ``k``: ``k + slack`` parts, one signature for each part that is not empty.  A set of ``n`` elements
  differs from a similar one, which has ``100 n / percent`` elements and ``M`` at most, in a number of elements
  that is known; all its other parts agree, so that many signatures are shared.  Only a set where this number
  is 0 gives signatures for empty parts too: two such sets agree on ``slack`` parts, empty ones included.

Frequent signatures say little and hold clusters together that have no link, so a set gives as few of them as
it may: of those it must share it leaves out all but one, the most frequent first (prefix filter).  How often a
signature occurs is read from a sketch of fixed size that the texts are counted into first; any order common
to all sets is right, so a sketch that is too coarse costs time and no link.

No pair of similar sets is missed.

**Candidates.**  Signatures are shuffled once and read sorted.  One that occurs once gives nothing; a rare
one gives its few pairs, of which those count that share as many signatures as similar sets must; a
frequent one links its classes to the least, a star instead of all pairs.  Tasks make stars of what is
frequent among their own rows before the shuffle, so a hot signature is a few rows of each.  The connected
components of both are the candidate clusters.

**Wide clusters.**  With more texts more signatures are frequent, and their stars hold texts together that share a
few passages.  A cluster of more than one block is therefore cut anew before its sets are compared, by the prefix
filter on the elements themselves: of a set at most ``100 - percent`` of 100 elements are missing in a similar one, so
by any order common to all sets the first of those that they share is among so many first ones and one more of both.
By ascending frequency most of these elements occur once; those that do not link their sets.  Each element of a wide
cluster is shuffled once, packed, and those that occur more than once a second time.

**Verification.**  A cluster is cut into blocks of bounded size; every pair of blocks is one group, in
which all intersections are counted exactly.  A group returns a spanning forest of its links (or all
links, :func:`links` with ``forest=False``), so a cluster of any size is never listed as pairs, and one
task holds two blocks at most.  This is done twice: first on the quarter of the elements that a hash
picks, which proves most pairs too different (they differ in more elements there than similar sets may
in all) and splits clusters that common passages hold together; then on whole sets.  The links'
components are the result.

Defined cases: null or word-less texts have an empty set and are linked with nothing; fewer words than
a shingle give one element, the whole sequence; rows that repeat are separate documents of one class;
a null id never names a component (one of null ids only has a null ``component_id``); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import arrow_map, documents, flat, giving_back, groups, row_key, ship, written
from .components import components
from .rolling import Prefix, U, fold_ascii, mix, word_bounds, word_prints

NAME = "op1_ngram_jaccard_join"
SHINGLE = 5
PERCENT = 80
#: Size bands grow by this factor (it must exceed 100 / percent).
BAND = 1.6
PAIRED = 7
#: Classes of a signature up to which its pairs are listed.
FEW = 16
#: Signature rows a task combines at once, and the marks of a frequent signature and of an edge in ``info``.
HELD = 1 << 19
MANY, EDGE = -1, -2
#: Counters of the sketch of signature frequencies (a power of two), and those in a row of it.
COUNTERS, SLICE = 1 << 22, 1 << 16
#: Elements of wide clusters packed at once, in a part at most, and counted at once; parts are two to this power at least.
PACKED, PART, COUNTED, LEAST_POWER = 1 << 19, 1 << 21, 1 << 20, 5
#: Set elements and sets in a block of a candidate cluster.
BLOCK_ELEMENTS = 1 << 19
BLOCK_SETS = 2048
#: Rows of a matrix of pairs that are tested at once.
ROWS = 256
#: One of so many elements is compared first.
PICKED = 4


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, flat, and their number per text."""
    start, end, first = word_bounds(buf, offsets)
    prefix = Prefix(word_prints(fold_ascii(buf), start, end))
    grams = prefix.windows(words)
    parts, sizes = [], []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            part = np.unique(grams[a:b - words + 1])
        else:
            part = prefix.ranges(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64)
        parts.append(part)
        sizes.append(len(part))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(sizes, dtype=np.int64)


def class_keys(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each set (0 for an empty one)."""
    total = np.zeros(len(elements) + 1, dtype=np.uint64)
    np.cumsum(mix(elements ^ U(0x2545F4914F6CDD1D)), out=total[1:])
    stop = np.cumsum(sizes)
    keys = mix((total[stop] - total[stop - sizes]) ^ mix(sizes.astype(np.uint64) * U(0x9E3779B97F4A7C15)))
    return np.where(sizes > 0, keys, U(0)).view(np.int64)


class Bands:
    """Size bands and, for each band's instance, how many elements similar sets may differ in."""

    def __init__(self, percent: int):
        if BAND * percent <= 100:
            raise ValueError("similarity is too low for the size bands")
        self.percent, starts = percent, [1]
        while starts[-1] < 1 << 40:
            starts.append(int(np.ceil(starts[-1] * BAND)))
        self.starts = np.array(starts)
        most = self.starts[1:] - 1
        self.differ = 2 * most * (100 - percent) // (100 + percent)

    def differ_most(self, sizes: np.ndarray, instance: np.ndarray) -> np.ndarray:
        """How many elements a set of each size and a similar one in the instance differ in at most."""
        partner = np.minimum(100 * sizes // self.percent, self.starts[instance + 1] - 1)
        return (100 - self.percent) * (sizes + partner) // (100 + self.percent)

    def memberships(self, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sets, instances): every non-empty set in its own band, then those that reach the next."""
        own = np.searchsorted(self.starts, sizes, side="right") - 1
        some = np.flatnonzero(sizes > 0)
        yield some, own[some]
        up = some[100 * sizes[some] >= self.percent * self.starts[own[some] + 1]]
        yield up, own[up] + 1


def slack(k: np.ndarray) -> np.ndarray:
    return np.maximum(6, -(-15 * k // 100))


def counter_of(sig: np.ndarray) -> np.ndarray:
    return (sig >> U(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def thinned(owner: np.ndarray, sig: np.ndarray, need: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of signatures without the most frequent ones of each owner (``often``: 0 for what is not frequent,
    else a number that grows with the frequency), as many as it may leave out and still share one: all sets leave
    out by one order, so of what two sets share at most the larger of their two numbers is gone."""
    hot = np.flatnonzero((often > 0) & (need > 1))
    hot = hot[np.lexsort((sig[hot], -often[hot], owner[hot]))]
    begin = np.flatnonzero(np.append(True, owner[hot][1:] != owner[hot][:-1])) if len(hot) else hot
    held = np.diff(np.append(begin, len(hot)))
    out = np.arange(len(hot)) - np.repeat(begin, held) < need[hot] - 1
    keep = np.ones(len(owner), dtype=bool)
    keep[hot[out]] = False
    gone = np.bincount(owner[hot[out]], minlength=int(owner.max()) + 1 if len(owner) else 0)
    return owner[keep], sig[keep], (need - gone[owner])[keep]


def signatures(elements: np.ndarray, sizes: np.ndarray, bands: Bands, often: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of all sets: (index of the set, signature, least number that similar sets share).  Two
    similar sets share at least the smaller of their two numbers.  ``often``: a sketch by :func:`counter_of`, by
    which frequent ones are :func:`thinned`."""
    owners, out, needs = [], [], []
    starts = np.cumsum(sizes) - sizes
    spread = mix(elements ^ U(0xC2B2AE3D27D4EB4F))
    for sets, instance in bands.memberships(sizes):
        if not len(sets):
            continue
        k = bands.differ[instance]
        parts = np.where(k <= PAIRED, k + 2, k + slack(k))
        base = np.cumsum(parts) - parts
        n = sizes[sets]
        which = np.repeat(np.arange(len(sets)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + starts[sets][which]
        part = base[which] + ((elements[at] >> U(20)) % parts[which].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(parts.sum()), dtype=np.uint64)
        np.add.at(sums, part, spread[at])
        filled = np.bincount(part, minlength=len(sums)) > 0
        slot_set = np.repeat(np.arange(len(sets)), parts)
        tag = instance[slot_set].astype(np.uint64) << U(40) | (np.arange(len(sums)) - base[slot_set]).astype(np.uint64)
        value = mix(np.where(filled, mix(sums), U(0)) ^ mix(tag + U(1)))
        single = k > PAIRED
        # parts that are not empty, without those in which a similar set may differ
        agree = np.add.reduceat(filled.astype(np.int64), base) - bands.differ_most(n, instance)
        emit = single[slot_set] & (filled | (agree < 1)[slot_set])
        owner, sig = slot_set[emit], value[emit]
        need = np.where(agree < 1, parts - k, agree)[owner]
        if often is not None:
            # sets that give empty parts share fewer with others than among themselves: they leave out nothing
            owner, sig, need = thinned(owner, sig, need, np.where((agree < 1)[owner], 0, often[counter_of(sig)]).astype(np.int64))
        owners.append(sets[owner])
        out.append(sig)
        needs.append(need)
        for differ in np.unique(k[~single]):
            chosen = np.flatnonzero(~single & (k == differ))
            grid = value[base[chosen][:, None] + np.arange(differ + 2)]
            for i in range(differ + 2):
                for j in range(i + 1, differ + 2):
                    owners.append(sets[chosen])
                    out.append(mix(grid[:, i] * U(5) ^ grid[:, j]))
                    needs.append(np.ones(len(chosen), dtype=np.int64))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(out), np.concatenate(needs)


def sets_of(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``rid, class, n_shingles`` of every row of ``docs`` (``rid`` and the text)."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buf, offsets = flat(batch.column(1))
        for i, j in groups(offsets):
            elements, sizes = shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(class_keys(elements, sizes)), pa.array(sizes)],
                                             names=["rid", "class", "n_shingles"])

    return arrow_map(docs.select("rid", text), run, "rid bigint, class bigint, n_shingles bigint")


def combined(sig: np.ndarray, keys: np.ndarray, info: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same rows with each class once for a signature.  A signature of more than ``FEW`` classes is known to be
    frequent: its least class stays, marked ``MANY``, and the others become edges to it (rows of the class, the
    least class and ``EDGE``), which are dealt by the class.  So a hot signature is a few rows of each task."""
    if not len(sig):
        return sig, keys, info
    by = np.lexsort((keys, sig))
    fresh = np.append(True, (sig[by][1:] != sig[by][:-1]) | (keys[by][1:] != keys[by][:-1]))
    by = by[fresh]
    begin = np.flatnonzero(np.append(True, sig[by][1:] != sig[by][:-1]))
    held = np.diff(np.append(begin, len(by)))
    many = np.repeat(held > FEW, held)
    hubs, rest = by[begin[held > FEW]], by[many & (np.arange(len(by)) != np.repeat(begin, held))]
    x, y = keys[rest], np.repeat(keys[hubs], held[held > FEW] - 1)
    at = np.lexsort((y, x))
    x, y = x[at], y[at]
    fresh = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(x) else np.zeros(0, dtype=bool)
    edges = x[fresh], y[fresh]
    few = np.sort(by[~many])
    return tuple(np.concatenate(c) for c in (
        (sig[few], sig[hubs], edges[0]), (keys[few], keys[hubs], edges[1]),
        (info[few], np.full(len(hubs), MANY), np.full(len(edges[0]), EDGE))))


def distinct_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Elements, sizes and class keys of the texts in the first column, some at a time and each class once of them."""
    buf, offsets = flat(batch.column(0))
    for i, j in groups(offsets):
        elements, sizes = shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
        keys = class_keys(elements, sizes)
        _, once = np.unique(keys, return_index=True)
        keep = np.zeros(len(keys), dtype=bool)
        keep[once] = True
        yield elements[np.repeat(keep, sizes)], sizes[keep], keys[keep]


def frequencies(docs: DataFrame, words: int, percent: int, text: str = "text") -> np.ndarray:
    """The sketch of signature frequencies: ``COUNTERS`` counters, 0 where what they count is not frequent."""
    spark, bands = docs.sparkSession, Bands(percent)
    ship(spark)

    def count(batches):
        total = np.zeros(COUNTERS, dtype="<u4")
        for batch in batches:
            for elements, sizes, _ in distinct_sets(batch, words):
                np.add.at(total, counter_of(signatures(elements, sizes, bands)[1]), 1)
        for i in range(0, COUNTERS, SLICE):
            if total[i:i + SLICE].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // SLICE], pa.int64()), pa.array([zlib.compress(total[i:i + SLICE].tobytes(), 1)])],
                                                 names=["slice", "counts"])

    def add_up(batches):
        totals = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = np.frombuffer(zlib.decompress(data), dtype="<u4").astype(np.int64)
                totals[at] = totals[at] + now if at in totals else now
        for at, now in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([int(now.sum())], pa.int64()), pa.array([np.minimum(now, 0xFFFF).astype("<u2").tobytes()])],
                                             names=["slice", "total", "counts"])

    schema = "slice bigint, counts binary"
    slices = docs.select(text).mapInArrow(giving_back(count), schema).repartition("slice").mapInArrow(giving_back(add_up), "slice bigint, total bigint, counts binary")
    out, total = np.zeros(COUNTERS, dtype=np.uint16), 0
    # COUNTERS / SLICE rows, however many texts there are
    for row in written(slices, "frequencies").collect():
        out[row["slice"] * SLICE:(row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], dtype="<u2")
        total += row["total"]
    out[out <= FEW + 2 * (total // COUNTERS)] = 0
    return out


def signature_rows(docs: DataFrame, words: int, percent: int, text: str = "text") -> DataFrame:
    """``sig, class, info`` rows (``info``: set size * 256 + least number of shared signatures, 255 at
    most), :func:`combined` by some ``HELD`` rows at a time."""
    bands = Bands(percent)
    ship(docs.sparkSession)
    sketch = docs.sparkSession.sparkContext.broadcast(frequencies(docs, words, percent, text))

    def rows_of(held):
        columns = [np.concatenate(c) for c in zip(*held)]
        held.clear()
        sig, keys, info = combined(*columns)
        del columns
        for i in range(0, len(sig), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[i:i + (1 << 16)]) for c in (sig, keys, info)], names=["sig", "class", "info"])

    def run(batches):
        held, entries = [], 0
        for batch in batches:
            for elements, sizes, keys in distinct_sets(batch, words):
                owner, sig, need = signatures(elements, sizes, bands, sketch.value)
                held.append((sig.view(np.int64), keys[owner], sizes[owner] * 256 + np.minimum(need, 255)))
                entries += len(sig)
                if entries > HELD:
                    yield from rows_of(held)
                    held, entries = [], 0
        if held:
            yield from rows_of(held)

    return docs.select(text).mapInArrow(giving_back(run), "sig bigint, class bigint, info bigint")


def near_pairs(keys: np.ndarray, info: np.ndarray, begin: np.ndarray, held: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of near sizes inside groups of ``held`` rows from ``begin`` on, with the number of signatures they need."""
    out = []
    for p in np.unique(held[held > 1]):
        lists = begin[held == p][:, None] + np.arange(p)
        x, y = np.triu_indices(p, 1)
        x, y = lists[:, x].ravel(), lists[:, y].ravel()
        n, m = info[x] >> 8, info[y] >> 8
        near = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        x, y = x[near], y[near]
        out.append((keys[x], keys[y], np.minimum(info[x] & 255, info[y] & 255)))
    return out


def candidate_clusters(docs: DataFrame, words: int, percent: int, text: str = "text") -> DataFrame:
    """``node, root``: classes that may be similar to another class, and their cluster.

    A signature of up to ``FEW`` classes gives its pairs of near sizes, and only pairs that share as many
    signatures as similar sets must are kept; a larger one gives a star.  A similar pair either shares a
    larger signature, or all it shares is counted.  Signatures are shuffled once, sorted, and read as a
    stream: of a signature a task holds ``FEW`` rows besides a batch, however many it has."""
    rows = signature_rows(docs, words, percent, text)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        none = np.zeros(0, np.int64)
        sig, keys, info = none, none, none

        def read(last: bool):
            """Edges of all signatures but the one that the next batch may go on with; ``need`` of a star's is 0."""
            nonlocal sig, keys, info
            if not len(sig):
                return
            group = np.append(True, sig[1:] != sig[:-1])
            # each class once; a row that is marked comes before one that is not
            fresh = np.flatnonzero(group | np.append(True, keys[1:] != keys[:-1]))
            sig, keys, info = sig[fresh], keys[fresh], info[fresh]
            begin = np.flatnonzero(group[fresh])
            held = np.diff(np.append(begin, len(sig)))
            many = (held > FEW) | (np.minimum.reduceat(info, begin) == MANY)
            out = near_pairs(keys, info, *(c[:len(c) if last else -1][~many[:len(c) if last else -1]] for c in (begin, held)), percent)
            star = np.flatnonzero(np.repeat(many, held) & (np.arange(len(sig)) != np.repeat(begin, held)))
            out.append((np.repeat(keys[begin], held)[star], keys[star], np.zeros(len(star), np.int64)))
            keep = slice(len(sig), None) if last else slice(begin[-1], begin[-1] + 1) if many[-1] else slice(begin[-1], None)
            sig, keys, info = sig[keep], keys[keep], np.full(1, MANY) if not last and many[-1] else info[keep]
            yield from out

        def edges(found):
            for a, b, need in found:
                for i in range(0, len(a), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i:i + (1 << 16)]) for c in (a, b, need)], names=["a", "b", "need"])

        for batch in batches:
            more = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            ready = more[2] == EDGE
            yield from edges([(more[1][ready], more[0][ready], np.zeros(int(ready.sum()), np.int64))])
            sig, keys, info = (np.concatenate([c, m[~ready]]) for c, m in zip((sig, keys, info), more))
            yield from edges(read(False))
        yield from edges(read(True))

    dealt = rows.repartition(n, "sig").sortWithinPartitions("sig", "class", "info")
    found = dealt.mapInArrow(giving_back(run), "a bigint, b bigint, need bigint")
    return components(found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need")).where("n >= need").select("a", "b"))


def intersections(elements: np.ndarray, owner: np.ndarray, n: int, popular: int = 64) -> np.ndarray:
    """Sizes of the pairwise intersections of ``n`` sets (upper triangle); ``owner`` ascends.  An element
    of few sets adds one to each of their pairs; those of more than ``popular`` sets are counted by
    products of 0/1 matrices."""
    out = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    begin = np.flatnonzero(np.append(True, elements[1:] != elements[:-1])) if len(elements) else np.zeros(0, np.int64)
    held = np.diff(np.append(begin, len(elements)))
    for p in np.unique(held[(held > 1) & (held <= popular)]):
        lists = owner[begin[held == p][:, None] + np.arange(p)]
        x, y = np.triu_indices(p, 1)
        for lo in range(0, len(lists), max(1, (1 << 21) // len(x))):
            some = lists[lo:lo + max(1, (1 << 21) // len(x))]
            np.add.at(out.reshape(-1), (some[:, x] * n + some[:, y]).ravel(), 1)
    many = np.flatnonzero(held > popular)
    step = max(64, (1 << 22) // max(n, 1))
    for lo in range(0, len(many), step):
        some = many[lo:lo + step]
        grid = np.zeros((n, len(some)), dtype=np.float32)
        at = np.repeat(begin[some], held[some]) + np.arange(held[some].sum()) - np.repeat(np.cumsum(held[some]) - held[some], held[some])
        grid[owner[at], np.repeat(np.arange(len(some)), held[some])] = 1
        out += np.triu(grid @ grid.T, 1)
    return out


def across(elements: np.ndarray, owner: np.ndarray, left: int, n: int, popular: int = 64) -> np.ndarray:
    """Sizes of the intersections of each of the first ``left`` sets with each of the other ``n - left``, counted
    as in :func:`intersections`; pairs within one side are neither counted nor held."""
    right = n - left
    out = np.zeros((left, right), dtype=np.float32)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    begin = np.flatnonzero(np.append(True, elements[1:] != elements[:-1])) if len(elements) else np.zeros(0, np.int64)
    held = np.diff(np.append(begin, len(elements)))
    ours = np.add.reduceat((owner < left).astype(np.int64), begin) if len(begin) else begin
    theirs = held - ours
    work = ours * theirs
    # an element of few sets: one for each left set with each right one
    few = np.flatnonzero((work > 0) & (held <= popular))
    for some in np.split(few, np.flatnonzero(np.diff(np.cumsum(work[few]) >> 21)) + 1):
        if not len(some):
            continue
        k = work[some]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        wide = np.repeat(theirs[some], k)
        x = owner[np.repeat(begin[some], k) + step // wide]
        y = owner[np.repeat(begin[some] + ours[some], k) + step % wide]
        np.add.at(out.reshape(-1), x * right + (y - left), 1)
    many = np.flatnonzero((work > 0) & (held > popular))
    width = max(64, (1 << 22) // max(n, 1))
    for lo in range(0, len(many), width):
        some = many[lo:lo + width]
        grid = np.zeros((n, len(some)), dtype=np.float32)
        at = np.repeat(begin[some], held[some]) + np.arange(held[some].sum()) - np.repeat(np.cumsum(held[some]) - held[some], held[some])
        grid[owner[at], np.repeat(np.arange(len(some)), held[some])] = 1
        out += grid[:left] @ grid[left:].T
    return out


def _pairs(sets: list[np.ndarray], side: np.ndarray, test) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that hold a common element and pass ``test(i, j, common)``; where both sides
    occur only pairs across the sides count."""
    order = np.argsort(side, kind="stable")
    left = int((side == side.min()).sum())
    two = left < len(sets)
    owner = np.repeat(np.arange(len(sets)), [len(sets[i]) for i in order])
    elements = np.concatenate([sets[i] for i in order])
    common = across(elements, owner, left, len(sets)) if two else intersections(elements, owner, len(sets))
    one, other = [], []
    # a few rows of the matrix at a time: in a group of near copies most entries are filled
    for lo in range(0, left, ROWS):
        i, j = np.nonzero(common[lo:lo + ROWS])
        count = common[lo + i, j].astype(np.int64)
        i, j = order[i + lo], order[j + left if two else j]
        good = test(i, j, count)
        one.append(i[good].astype(np.int32))
        other.append(j[good].astype(np.int32))
    return np.concatenate(one), np.concatenate(other)


def linked_pairs(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with ``100 * intersection >= percent * union``."""
    return _pairs(sets, side, lambda i, j, c: 100 * c >= percent * (sizes[i] + sizes[j] - c))


def possible_pairs(picked: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that their picked elements do not prove different; pairs without a common picked element can
    only be possible where a set has few of them, and such sets are all put together."""
    n = np.array([len(x) for x in picked])

    def test(i, j, c):
        total = sizes[i] + sizes[j]
        return ((100 + percent) * (n[i] + n[j] - 2 * c) <= (100 - percent) * total) & (
            100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))

    i, j = _pairs(picked, side, test)
    few = np.flatnonzero((100 + percent) * percent * n <= (100 - percent) * (100 + percent) * sizes)
    return np.concatenate([i, few[:-1]]), np.concatenate([j, few[1:]])


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges."""
    up, keep = list(range(n)), []

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for e, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = find(x), find(y)
        if x != y:
            up[x] = y
            keep.append(e)
    return i[keep], j[keep]


def blocked_pairs(members: DataFrame, bodies: DataFrame, read, compare, forest: bool) -> DataFrame:
    """``a, b``: classes that ``compare(sets, sizes, side)`` pairs, over all pairs of blocks of each
    cluster.  ``members`` has ``root, class, rid, n`` and ``carried``, the number of elements in a body; ``bodies``
    has ``rid, body``, which ``read(buf, offsets)`` turns into elements, flat, and their numbers.  Blocks are laid
    out over the narrow rows; a body is dealt once by ``rid`` and then to its groups."""
    spark = members.sparkSession
    ship(spark)
    need = F.greatest(F.ceil(F.sum("carried") / F.lit(BLOCK_ELEMENTS)), F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)))
    totals = members.groupBy("root").agg(need.cast("int").alias("blocks"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    placed = members.join(totals, "root").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows that repeat share a row key
    held_once = bodies.join(members.select("rid"), "rid", "left_semi").dropDuplicates(["rid"])
    grouped = (paired.select("rid", "root", lo.alias("lo"), hi.alias("hi"), "block", "class", "n").join(held_once, "rid")
               .select("root", "lo", "hi", "block", "class", "n", "body")
               .repartition(n, "root", "lo", "hi").sortWithinPartitions("root", "lo", "hi"))

    def finish(group, held) -> pa.RecordBatch | None:
        sets = [x for part in held for x in part[0]]
        side, keys, sizes = (np.concatenate([part[k] for part in held]) for k in (1, 2, 3))
        if len(sets) < 2 or group[1] != group[2] and side.min() == side.max():
            return None
        i, j = compare(sets, sizes, side)
        if forest:
            i, j = spanning(len(sets), i, j)
        return pa.RecordBatch.from_arrays([pa.array(keys[i]), pa.array(keys[j])], names=["a", "b"])

    def run(batches):
        group, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            head = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            change = np.flatnonzero(np.any([h[1:] != h[:-1] for h in head], axis=0)) + 1
            side, keys, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in (3, 4, 5))
            buf, offsets = flat(batch.column(6))
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                now = tuple(int(h[a]) for h in head)
                if now != group:
                    if held and (out := finish(group, held)) is not None:
                        yield out
                    group, held = now, []
                for i, j in groups(offsets[a:b + 1]):
                    at = offsets[a + i:a + j + 1]
                    elements, count = read(buf[at[0]:at[-1]], at - at[0])
                    held.append((np.split(elements, np.cumsum(count)[:-1]), side[a + i:a + j], keys[a + i:a + j], sizes[a + i:a + j]))
        if held and (out := finish(group, held)) is not None:
            yield out

    return grouped.mapInArrow(giving_back(run), "a bigint, b bigint")


def picked_sets(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``rid, body``: the picked elements of each row's set, 32 bits of each."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buf, offsets = flat(batch.column(1))
        for i, j in groups(offsets):
            elements, sizes = shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
            pick = elements % U(PICKED) == 0
            counts = np.bincount(np.repeat(np.arange(j - i), sizes)[pick], minlength=j - i)
            body = (elements[pick] >> U(32)).astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(counts) * 4]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.Array.from_buffers(
                pa.binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(body)])], names=["rid", "body"])

    return arrow_map(docs.select("rid", text), run, "rid bigint, body binary")


def read_picked(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Picked elements again; two that agree in their 32 bits count once, which only keeps a pair possible."""
    whole = np.frombuffer(buf.tobytes(), dtype="<u4")
    parts = [np.unique(whole[a // 4:b // 4]) for a, b in zip(offsets[:-1], offsets[1:])]
    return np.concatenate(parts), np.array([len(p) for p in parts])


def packed(prints: np.ndarray, keys: np.ndarray, sizes: np.ndarray, power: int) -> pa.RecordBatch:
    """Elements of sets in ``2**power`` parts by their high bits, a row for each part: the classes in it, how many
    elements each has there, and their 48 low bits."""
    part = (prints >> U(64 - power)).astype(np.int32)
    by = np.argsort(part, kind="stable")
    part, owner = part[by], np.repeat(np.arange(len(sizes)), sizes)[by]
    first = np.append(True, part[1:] != part[:-1])
    run = np.flatnonzero(first | np.append(True, owner[1:] != owner[:-1]))
    begin = np.flatnonzero(first)
    low = np.ascontiguousarray(prints[by].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    ends, runs = np.append(begin, len(part)), np.searchsorted(run, np.append(begin, len(part)))

    def rows(width, bounds, data):
        return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer((width * bounds).astype(np.int32)), pa.py_buffer(data.tobytes())])

    return pa.RecordBatch.from_arrays(
        [pa.array(part[begin]), rows(8, runs, keys[owner[run]].astype("<i8")), rows(4, runs, np.diff(np.append(run, len(part))).astype("<u4")),
         rows(6, ends, low)], names=["part", "classes", "counts", "prints"])


def shared_elements(texts: DataFrame, words: int, power: int) -> DataFrame:
    """``element, class, held`` for the elements of ``texts`` (``class, root, body``) that occur in a cluster more than once,
    and how often.  An element is its 48 low bits and the 16 high bits of its part: two of a set that agree in them stay
    two rows, so that a set still has as many as it has shingles, and count as frequent ones."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ship(texts.sparkSession)

    def pack(batches):
        held, entries = [], 0
        for batch in batches:
            keys, roots = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            buf, offsets = flat(batch.column(2))
            for i, j in groups(offsets):
                elements, sizes = shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
                # an element counts for its cluster alone
                prints = mix(elements ^ np.repeat(mix(roots[i:j].view(np.uint64)), sizes))
                held.append((prints, keys[i:j], sizes))
                entries += len(prints)
                if entries > PACKED:
                    yield packed(*(np.concatenate(c) for c in zip(*held)), power)
                    held, entries = [], 0
        if entries:
            yield packed(*(np.concatenate(c) for c in zip(*held)), power)

    def count(part, held):
        low = np.concatenate([x for x, _ in held])
        keys = np.concatenate([x for _, x in held])
        held.clear()
        bits, high = (len(low) // COUNTED).bit_length(), U((part >> max(0, power - 16)) << 48)
        for some in range(1 << bits):
            at = np.flatnonzero(low >> U(48 - bits) == U(some)) if bits else np.arange(len(low))
            at = at[np.argsort(low[at], kind="stable")]
            begin = np.flatnonzero(np.append(True, low[at][1:] != low[at][:-1])) if len(at) else at
            often = np.diff(np.append(begin, len(at)))
            often = np.repeat(often, often)
            at, often = at[often > 1], often[often > 1]
            for i in range(0, len(at), 1 << 16):
                now = at[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array((low[now] | high).view(np.int64)), pa.array(keys[now]), pa.array(often[i:i + (1 << 16)])],
                                                 names=["element", "class", "held"])

    def run(batches):
        part, held = None, []
        for batch in batches:
            for i, now in enumerate(batch.column(0).to_pylist()):
                if now != part:
                    if held:
                        yield from count(part, held)
                    part, held = now, []
                keys, counts, prints = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind) for c, kind in ((1, "<i8"), (2, "<u4"), (3, np.uint8)))
                low = np.zeros((len(prints) // 6, 8), dtype=np.uint8)
                low[:, :6] = prints.reshape(-1, 6)
                held.append((low.view("<u8").ravel(), np.repeat(keys, counts)))
        if held:
            yield from count(part, held)

    rows = texts.select("class", "root", "body").mapInArrow(giving_back(pack), "part int, classes binary, counts binary, prints binary")
    return rows.repartition(n, "part").sortWithinPartitions("part").mapInArrow(giving_back(run), "element bigint, class bigint, held bigint")


def narrowed(members: DataFrame, docs: DataFrame, words: int, percent: int, text: str = "text") -> DataFrame:
    """``members`` (``class, rid, n, root``) with each cluster of more than one block cut by the prefix filter on its elements.
    A set that shares none of those it must share one of is similar to no other and goes."""
    size = members.groupBy("root").agg(F.sum("n").alias("elements"), F.count(F.lit(1)).alias("m"))
    wide = written(size.where((F.col("elements") > BLOCK_ELEMENTS) | (F.col("m") > BLOCK_SETS)), "wide")
    total = wide.agg(F.sum("elements")).first()[0]
    if not total:
        return members
    inside = written(members.join(wide.select("root"), "root", "left_semi").select(*members.columns), "inside")
    bodies = docs.select("rid", F.col(text).alias("body")).join(inside.select("rid"), "rid", "left_semi").dropDuplicates(["rid"])
    power = min(30, max(LEAST_POWER, (int(total) // PART).bit_length()))
    shared = written(shared_elements(inside.select("rid", "class", "root").join(bodies, "rid"), words, power), "shared")
    # the most frequent ones that a set must share, less one, go; those that occur once would come after all of these
    order = Window.partitionBy("class").orderBy(F.desc("held"), "element")
    most = F.expr(f"n - ({100 - percent} * n) div 100 - 1")
    first = written(shared.join(inside.select("class", "n"), "class").withColumn("rank", F.row_number().over(order)).where(F.col("rank") > most)
                    .select("element", "class"), "first")
    least = written(first.groupBy("element").agg(F.min("class").alias("hub"), F.max("class").alias("last")).where("hub < last").drop("last"), "hubs")
    found = components(first.join(least, "element").where("class <> hub").select(F.col("hub").alias("a"), F.col("class").alias("b")))
    cut = inside.drop("root").join(found, F.col("class") == F.col("node")).select(*members.columns)
    return written(members.join(wide.select("root"), "root", "left_anti").select(*members.columns).unionByName(cut), "members")


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int, text: str = "text", forest: bool = True) -> DataFrame:
    """``a, b``: links between classes; all of them, or a spanning forest of each group of blocks.

    ``docs`` has ``rid`` and the text, ``classes`` is :func:`sets_of` of it (written)."""
    one = classes.groupBy("class").agg(F.min("rid").alias("rid"), F.min("n_shingles").alias("n"))
    sets, place = lambda b, o: shingle_sets(b, o, words), F.col("class") == F.col("node")
    # a row key names one text, or rows that repeat with equal sets: a class keeps one of them
    member = written(one.join(candidate_clusters(docs, words, percent, text), place).drop("node"), "members")
    member = narrowed(member, docs, words, percent, text)
    # written: the texts need not be cut again to count their picked elements
    first = written(picked_sets(docs, words, text).join(member.select("rid"), "rid", "left_semi").dropDuplicates(["rid"]), "picked")
    sized = first.select("rid", (F.octet_length("body") / 4).alias("carried"))
    possible = components(blocked_pairs(member.join(sized, "rid"), first, read_picked,
                                        lambda s, n, side: possible_pairs(s, n, side, percent), True))
    member = written(one.join(possible, place).drop("node").withColumn("carried", F.col("n")), "members")
    return blocked_pairs(member, docs.select("rid", F.col(text).alias("body")), sets,
                         lambda s, n, side: linked_pairs(s, n, side, percent), forest)


def join(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: ``rid`` (row key), ``doc_id``, ``n_shingles``, ``class`` (fingerprint of its set, 0 for an
    empty one), ``component`` (a fingerprint too; null for an empty set) and ``component_id``, the least
    id reachable by links, its own included."""
    plain = docs.select(row_key(id_col, text).alias("rid"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    classes = written(sets_of(plain, words), "classes")
    found = components(links(plain, classes.where("n_shingles > 0"), words, percent))
    # ids travel with the row key; rows that repeat in id and text share both
    ids = plain.select("rid", "doc_id").distinct()
    rows = classes.join(ids, "rid").join(found, F.col("class") == F.col("node"), "left").select(
        "rid", "doc_id", "n_shingles", "class",
        F.when(F.col("n_shingles") > 0, F.coalesce("root", "class")).alias("component"))
    rows = written(rows, "rows")
    least = written(rows.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    return rows.join(least, "component", "left").select(
        "rid", "doc_id", "n_shingles", "class", "component",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates, all columns unchanged: of every component the row of
    the least id (ties: least row key, one row if rows repeat) stays, and so does every row with an
    empty set."""
    columns = list(docs.columns)
    names = [f"c{i}" for i in range(len(columns))]
    inner_text, inner_id = f"c{columns.index(text)}", f"c{columns.index(id_col)}"
    plain = docs.toDF(*names)
    found = join(plain.select(inner_id, inner_text), words, percent, inner_text, inner_id)
    best = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("best"))
    keep = best.select(F.col("best.rid").alias("rid"), F.lit(True).alias("one")).unionByName(
        found.where("component IS NULL").select("rid", F.lit(False).alias("one")).distinct())
    rows = plain.withColumn("rid", row_key(inner_id, inner_text)).join(keep, "rid")
    # of rows that repeat one stays; rows with empty sets all stay
    tied = F.when(F.col("one"), F.lit(0)).otherwise(F.monotonically_increasing_id())
    return rows.withColumn("tie", tied).dropDuplicates(["rid", "tie"]).select(*names).toDF(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under four-word shingles and a similarity of 0.85."""
    return join(documents(spark, sf_dir), 4, 85).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT rid, md5(CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END) AS h
      FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.rid <> y.rid GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n m ON m.rid = a JOIN n o ON o.rid = b WHERE 100 * c >= 85 * (m.n + o.n - c)),
r AS (SELECT rid, rid AS seen FROM n UNION SELECT r.rid, l.b FROM r JOIN l ON l.a = r.seen),
m AS (SELECT r.rid, min(doc_id) AS least FROM r JOIN d ON d.rid = r.seen GROUP BY r.rid)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN n.n IS NULL THEN doc_id ELSE m.least END AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)
"""
