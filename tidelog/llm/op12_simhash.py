"""SimHash near-dedup with vantage-point trees.

**Fingerprints.**  A text's words are lower-cased (A-Z); every shingle of three words, repeats included,
is hashed by XXH64 with seed 42, and a fingerprint bit is 1 if it is set in over half of the hashes.
Fingerprints link when they differ in at most ``radius`` bits.  Equal ones count once from there on.

**Trees.**  The 64 bits are cut into ``blocks``; fingerprints within ``radius`` are within
``bound = radius // blocks`` in one block at least.  Each block has its tree: a fingerprint's shard is its
Hamming distances, inside the block, to ``VANTAGES`` fixed vantage points.  By the triangle bound a
partner's distances differ by ``bound`` at most, and all by the same parity, so a fingerprint goes to its
own shard and to the boundary-overlapping ones with a higher key.  Three bits and four blocks give a
bound of 0: one shard in each tree.

**Shards.**  A shard is searched exactly by a vantage-point tree over whole fingerprints: distances to a
vantage point, split at their median, and only parts whose distances overlap within ``radius`` are joined;
parts that are linked already are not compared again.  Links come out as a spanning forest, so a group of
near copies is never listed as pairs.  A shard of more than ``CAP`` fingerprints is cut into pieces by the
distance to a vantage point of its own, and only pieces whose distances are within ``radius`` meet: a task
holds two pieces at most, whatever the group.

**Scale.**  Texts are read once and not shuffled; from there on rows are ids and 64-bit fingerprints.
Both sides of every join are written tables or plain shuffles, so a fingerprint that holds any share of
the documents can be split.

Defined cases: null and word-less texts have fingerprint 0 and link like any other; fewer words than a
shingle are one shingle, the whole sequence; rows that repeat are documents of their own; null ids never
name a component (one of null ids only has a null ``component_id``); an empty table gives an empty
result; other columns are not read.  A text is hashed about ``PIECE`` bytes at a time.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, documents, ship, written
from .components import components
from .rolling import U, mix

NAME = "op12_simhash_dedup"
SQL = None
WORDS = 3
RADIUS = 3
BLOCKS = 4
VANTAGES = 8
#: Bytes of a text hashed at once.
PIECE = 1 << 20
#: Fingerprints of a shard, or of a piece of one, that a task takes at once.
CAP = 1 << 17
#: Shards up to this size, and leaves of a tree, are compared directly.
LEAF = 64
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(raw: bytes, limit: int) -> Iterator[bytes]:
    """The text in parts that end before white space."""
    at = 0
    while at < len(raw):
        gap = SPACE.search(raw, at + limit)
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end


def shingle_hashes(raw: bytes, words: int = WORDS, limit: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle as rows of eight bytes, the highest first."""
    carry, digest, some = [], xxhash.xxh64_digest, False
    for part in pieces(raw, limit):
        held = carry + part.lower().split()
        if len(held) < words:
            carry = held
            continue
        stop = np.cumsum([len(w) + 1 for w in held]) - 1
        start = np.append(0, stop[:-1] + 1)
        line = b" ".join(held)
        yield np.frombuffer(b"".join([digest(line[a:b], 42) for a, b in zip(start[:len(held) - words + 1].tolist(), stop[words - 1:].tolist())]),
                            dtype=np.uint8).reshape(-1, 8)
        carry, some = held[len(held) - words + 1:], True
    if carry and not some:
        yield np.frombuffer(digest(b" ".join(carry), 42), dtype=np.uint8).reshape(-1, 8)


def fingerprint(raw: bytes, words: int = WORDS, limit: int = PIECE) -> int:
    ones, total = np.zeros(64, dtype=np.int64), 0
    for rows in shingle_hashes(raw, words, limit):
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
        total += len(rows)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, fp`` of every row."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fp = [fingerprint(t.as_buffer().to_pybytes(), words) if t.is_valid else 0 for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return arrow_map(picked, run, f"doc_id {kind}, fp bigint")


class Forest:
    """Linked sets of items, kept as an array."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def labels(self, items: np.ndarray) -> np.ndarray:
        now = self.up[items]
        while True:
            then = self.up[now]
            if (then == now).all():
                break
            now = then
        self.up[items] = now
        return now

    def link(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links pairs in order and gives those that joined two sets."""
        up = self.up
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = x, y
            while up[p] != p:
                p = up[p]
            while up[q] != q:
                q = up[q]
            up[x], up[y] = p, q
            if p != q:
                up[max(p, q)] = min(p, q)
                yield x, y


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def search(fp: np.ndarray, radius: int, parts: tuple[np.ndarray, np.ndarray | None], forest: Forest, leaf: int = LEAF) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of the pairs within ``radius``: inside ``parts[0]`` or, with a second part,
    across the two (indices of ``fp``)."""
    stack = [parts]
    while stack:
        a, b = stack.pop()
        if not len(a) or b is not None and not len(b):
            continue
        of_a, of_b = forest.labels(a), None if b is None else forest.labels(b)
        if (of_a == of_a[0]).all() and (b is None or (of_b == of_a[0]).all()):
            continue
        if (len(a) if b is None else max(len(a), len(b))) <= leaf:
            other, of = (a, of_a) if b is None else (b, of_b)
            i, j = np.nonzero((distance(fp[a][:, None], fp[other][None, :]) <= radius) & (of_a[:, None] != of[None, :]))
            yield from forest.link(a[i], other[j])
            continue
        if b is None:
            v = a[len(a) // 2]
            d = distance(fp[a], fp[v])
            near = d <= radius
            yield from forest.link(np.full(int(near.sum()), v), a[near])
            # what is near the vantage point is linked; it is only searched for partners further out
            rest, to = a[~near], d[~near]
            stack.append((rest[to <= 2 * radius], a[near & (d > 0)]))
            if not len(rest):
                continue
            middle = np.median(to)
            inner = to <= middle
            if min(inner.sum(), (~inner).sum()) < len(rest) / 16:
                half = len(rest) // 2
                stack += [(rest[:half], None), (rest[half:], None), (rest[:half], rest[half:])]
            else:
                stack += [(rest[inner], None), (rest[~inner], None),
                          (rest[inner & (to > middle - radius)], rest[~inner & (to <= middle + radius)])]
            continue
        if len(a) < len(b):
            a, b = b, a
        v = fp[a[len(a) // 2]]
        da, db = distance(fp[a], v), distance(fp[b], v)
        middle = np.median(da)
        ia, ib = da <= middle, db <= middle
        if min(ia.sum(), (~ia).sum()) < len(a) / 16:
            half = len(a) // 2
            stack += [(a[:half], b), (a[half:], b)]
            continue
        stack += [(a[ia], b[ib]), (a[~ia], b[~ib]),
                  (a[ia & (da > middle - radius)], b[~ib & (db <= middle + radius)]),
                  (a[~ia & (da <= middle + radius)], b[ib & (db > middle - radius)])]


def shard_links(fp: np.ndarray, shard: np.ndarray, side: np.ndarray, radius: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each shard (rows come shard by shard); where both sides occur, across the sides."""
    begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    size = np.diff(np.append(begin, len(shard)))
    forest, out = Forest(len(fp)), []
    # rows of one fingerprint in several shards are one item
    _, first, same = np.unique(fp, return_index=True, return_inverse=True)
    item = first[same]
    sided = np.add.reduceat(side, begin) * (size - np.add.reduceat(side, begin)) > 0
    small = np.repeat((size <= leaf) & ~sided, size)
    rows = np.flatnonzero(small)
    f, s = fp[rows], shard[rows]
    for step in range(1, leaf):
        together = s[step:] == s[:-step]
        if not together.any():
            break
        at = np.flatnonzero(together & (distance(f[step:], f[:-step]) <= radius))
        out += forest.link(item[rows[at]], item[rows[at + step]])
    for a, n, two in zip(begin.tolist(), size.tolist(), sided.tolist()):
        if two or n > leaf:
            part = np.arange(a, a + n)
            halves = (part[side[part] == 0], part[side[part] == 1]) if two else (part, None)
            out += search(fp, radius, (item[halves[0]], None if halves[1] is None else item[halves[1]]), forest, leaf)
    pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _packed(distances: list) -> F.Column:
    key = F.lit(0).cast("bigint")
    for i, d in enumerate(distances):
        key = key + F.shiftleft(d.cast("bigint"), 6 * i)
    return key


def shards(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, vantages: int = VANTAGES) -> DataFrame:
    """``tree, shard, fp``: the shards of every row's ``fp``, boundary-overlapping ones included."""
    if not 1 <= blocks <= 64 or not 1 <= vantages <= 10:
        raise ValueError("1 to 64 blocks, 1 to 10 vantage points")
    bound, width, trees = radius // blocks, 64 // blocks, []
    for tree in range(blocks):
        low, high = tree * width, 64 if tree == blocks - 1 else (tree + 1) * width
        mask = ((1 << high) - (1 << low)).to_bytes(8, "big")
        points = mix(np.arange(1, vantages + 1, dtype=np.uint64) + U(tree << 8)).view(np.int64).tolist()
        inside = F.col("fp").bitwiseAND(F.lit(int.from_bytes(mask, "big", signed=True)))
        own = _packed([F.bit_count(inside.bitwiseXOR(F.lit(p & int.from_bytes(mask, "big", signed=True)))) for p in points])
        # a partner at block distance d differs from every vantage distance by -d, -d + 2, ... or d
        steps = sorted({sum(x << 6 * i for i, x in enumerate(move)) for d in range(bound + 1)
                        for move in itertools.product(range(-d, d + 1, 2), repeat=vantages)})
        trees.append(F.struct(F.lit(tree).alias("tree"), F.array(*(own + F.lit(s) for s in steps if s >= 0)).alias("shards")))
    each = prints.select("fp", F.explode(F.array(*trees)).alias("t"))
    return each.select(F.col("t.tree").alias("tree"), F.explode("t.shards").alias("shard"), "fp")


def cells(rows: DataFrame, radius: int, cap: int) -> DataFrame:
    """``tree, shard, lo, hi, side, fp``: shards of up to ``cap`` rows as they are, larger ones as pairs of
    pieces, cut by the distance to a vantage point of the shard."""
    hot = written(rows.groupBy("tree", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("v")).where(F.col("n") > cap)
                  .select("tree", "shard", "v"), "hot_shards")
    far = F.bit_count(F.col("fp").bitwiseXOR(F.col("v")))
    placed = rows.join(hot, ["tree", "shard"], "left")
    # at most 65 distances in a shard's map
    bands = written(placed.where("v IS NOT NULL").groupBy("tree", "shard", far.alias("d")).agg(F.ceil(F.count(F.lit(1)) / F.lit(cap)).cast("int").alias("n"))
                    .groupBy("tree", "shard").agg(F.map_from_entries(F.collect_list(F.struct("d", "n"))).alias("bands")), "hot_bands")
    none = F.lit(0)
    plain = placed.where("v IS NULL").select("tree", "shard", none.alias("lo"), none.alias("hi"), none.alias("side"), "fp")
    cut = placed.where("v IS NOT NULL").join(bands, ["tree", "shard"]).withColumn("d", far)
    # a cell is a pair of pieces; a piece is numbered by its distance and its place there
    number = lambda d, p: d * F.lit(1 << 24) + p
    cut = cut.withColumn("own", number(F.col("d"), F.pmod(F.xxhash64("fp"), F.element_at("bands", F.col("d"))).cast("int")))
    cut = cut.withColumn("e", F.explode(F.sequence(F.col("d") - radius, F.col("d") + radius)))
    cut = cut.where("bands[e] IS NOT NULL").withColumn("p", F.explode(F.sequence(F.lit(0), F.element_at("bands", F.col("e")) - 1)))
    other = number(F.col("e"), F.col("p"))
    pieces_of = cut.select("tree", "shard", F.least("own", other).alias("lo"), F.greatest("own", other).alias("hi"),
                           F.when(F.col("own") > other, 1).otherwise(0).alias("side"), "fp")
    return plain.unionByName(pieces_of)


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, vantages: int = VANTAGES, cap: int = CAP) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` (a spanning forest of each shard's)."""
    spark = prints.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", "shard", "lo", "hi"]
    dealt = cells(shards(prints, radius, blocks, vantages), radius, cap).repartition(n, *keys).sortWithinPartitions(*keys)

    def run(batches):
        held, size = [], 0

        def done(columns, whole):
            """Links of the complete cells; the rows of the last one, unless ``whole``."""
            change = np.append(True, np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0))
            cut = len(change) if whole else int(np.flatnonzero(change)[-1])
            if cut:
                fp = columns[5][:cut]
                a, b = shard_links(fp.view(np.uint64), np.cumsum(change[:cut]), columns[4][:cut].astype(np.int64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])
            rest = [c[cut:] for c in columns]
            held[:] = [rest] if len(rest[0]) else []

        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)])
                size += batch.num_rows
                if size >= cap // 2:
                    yield from done([np.concatenate(c) for c in zip(*held)], False)
                    size = 0
        if held:
            yield from done([np.concatenate(c) for c in zip(*held)], True)

    return dealt.select(*keys, "side", "fp").mapInArrow(run, "a bigint, b bigint")


def deduplicate(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS, text: str = "text", id_col: str = "doc_id",
                vantages: int = VANTAGES, cap: int = CAP) -> DataFrame:
    """Per row: the id, ``fp`` (the fingerprint as a long), ``fingerprint`` (16 hex digits) and
    ``component_id``, the least id reachable by links, its own included."""
    rows = written(fingerprints(docs, words, text, id_col), "prints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_prints")
    found = components(written(links(distinct, radius, blocks, vantages, cap), "print_links"))
    # fingerprints without a link are alone
    linked = written(distinct.join(found, F.col("fp") == F.col("node")).select("fp", "least", "root"), "linked")
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = written(linked.join(least, "root").select("fp", "component_id").unionByName(
        distinct.join(linked, "fp", "left_anti").select("fp", F.col("least").alias("component_id"))), "named")
    return rows.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents: three-word shingles, three bits."""
    return deduplicate(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
