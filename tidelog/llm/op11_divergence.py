"""Audit of how far the sources of a language diverge in their vocabulary.

**Partial counts.**  Inside ``mapInArrow`` an Arrow compute pipeline (``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``) turns texts into counts of
(lang, source, term): occurrences and documents.  A task adds up what it has read, up to ``HELD`` rows,
before it sends anything.  Spark sums the partial counts; each language keeps the terms in at least
``least`` of its documents.

**Probabilities** are whole numbers, ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, with ``N`` the
group's occurrences of kept terms and ``V`` the number of kept terms.  ``f(p, q) = floor((p - q)**2 / (p +
q))``.  All arithmetic is exact in 64 bits up to 2.9e14 occurrences of a group.

**Pairs of sources.**  Kept counts are dealt by language, block pair of sources and hash of the term into
columnar shards; a shard has whole terms.  It makes a matrix of terms by sources and adds up ``f`` for
every pair; terms that no source of the shard has give ``f(p(0), p(0))`` each and are added at the end.
Sources are taken ``SIDE`` at a time, so a shard's matrix is bounded whatever the number of sources.
**Terms** of a group are compared with their language and ranked by a window that keeps its first ranks
before the shuffle.

**Scale.**  Texts are read once (and the groups' names once more, as columns of their own) and never
shuffled.  Counts are reduced in the tasks first, so a hot source has one row for each of its terms in
each task.  Group totals join the counts as written tables; the planner broadcasts them while they are
small.

Defined cases: null text, language or source are ''; a text without terms counts for its group only; rows
that repeat are documents of their own; a language without kept terms has pairs of value 0 and no terms;
an empty table gives an empty result; other columns are not read.  Texts are taken about ``PIECE`` bytes
at a time; a longer text stands alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import documents, ship, written

NAME = "op11_source_divergence"
#: Fixed value: what separates terms, every ASCII character but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST = 10
RANKS = 10
SCALE = 10 ** 9
PIECE = 4 << 20
#: Rows of partial counts that a task holds.
HELD = 1 << 19
#: Sources of one side of a shard, and rows of counts in a shard.
SIDE = 128
SHARD_ROWS = 1 << 17


def slices(batch: pa.RecordBatch, column: int, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` bytes in ``column``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, n, docs`` of a batch of ``lang, source, text``."""
    lists = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), pattern=BETWEEN)
    table = pa.table({"doc": pc.list_parent_indices(lists), "term": pc.list_flatten(lists)})
    table = table.filter(pc.greater(pc.binary_length(table["term"]), 0))
    terms = table["term"].combine_chunks()
    coded = (terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms).dictionary_encode()
    seen = pa.table({"doc": table["doc"], "code": coded.indices}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    of = {name: pc.fill_null(batch.column(i), "").dictionary_encode() for i, name in enumerate(("lang", "source"))}
    lang, source = (of[x].indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in ("lang", "source"))
    group = pa.array(lang * len(of["source"].dictionary) + source)
    merged = pa.table({"group": group.take(seen["doc"]), "code": seen["code"], "n": seen["count_all"]}).group_by(
        ["group", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    number = merged["group"].to_numpy()
    return pa.table({"lang": of["lang"].dictionary.take(pa.array(number // len(of["source"].dictionary))) if len(number) else pa.array([], pa.string()),
                     "source": of["source"].dictionary.take(pa.array(number % len(of["source"].dictionary))) if len(number) else pa.array([], pa.string()),
                     "term": coded.dictionary.take(merged["code"].combine_chunks()),
                     "n": merged["n_sum"].cast(pa.int64()), "docs": merged["count_all"].cast(pa.int64())})


def add_up(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def partial_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``, a few rows of each key in each task, from ``lang, source, text``."""
    ship(docs.sparkSession)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for part in slices(batch, 2):
                held.append(count_terms(part))
                rows += held[-1].num_rows
                if rows > HELD:
                    held = [add_up(held)]
                    rows = held[0].num_rows
                    if rows > HELD // 2:
                        yield from held[0].to_batches(max_chunksize=1 << 16)
                        held, rows = [], 0
        if held:
            yield from add_up(held).to_batches(max_chunksize=1 << 16)

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def scaled(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * count / total)`` for ``count <= total``, in two exact divisions of longs."""
    first = count * F.lit(31250)
    return F.lit(1) + F.call_function("div", first, total) * F.lit(32000) + F.call_function("div", (first % total) * F.lit(32000), total)


def scaled_array(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    first = count * 31250
    return 1 + first // total * 32000 + first % total * 32000 // total


def gap(p, q):
    return (p - q) * (p - q) // (p + q)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def pair_sums(kept: DataFrame, groups: DataFrame, side: int = SIDE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``lang, a, b, seen, value``: for pairs of sources (numbers ``a < b`` in ``groups``) partial sums of
    ``f`` over the ``seen`` terms of each shard."""
    spark = kept.sparkSession
    ship(spark)
    shards = max(1, -(-kept.count() // shard_rows))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    blocks = F.ceil(F.col("groups") / F.lit(side)).cast("int")
    block = _div(F.col("number"), F.lit(side)).cast("int")
    # the other blocks that a source's block meets, its own included
    meet = F.explode(F.sequence(F.lit(0), blocks - 1))
    keys = ["lang", "lo", "hi", "shard"]
    heads = groups.withColumn("other", meet).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        "lang", F.least(block, "other").alias("lo"), F.greatest(block, "other").alias("hi"), "shard", F.lit("").alias("term"),
        "number", F.col("total").alias("n"), F.lit(True).alias("head"))
    counts = kept.join(groups.drop("total"), ["lang", "source"]).withColumn("other", meet).select(
        "lang", F.least(block, "other").alias("lo"), F.greatest(block, "other").alias("hi"),
        F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"), "term", "number", "n", F.lit(False).alias("head"))
    dealt = heads.unionByName(counts).repartition(n, *keys).sortWithinPartitions(*keys, F.col("head").desc())

    def finish(key, held: pa.Table):
        head = held["head"].to_numpy()
        number, n = held["number"].to_numpy(), held["n"].to_numpy()
        column, total = number[head], n[head]
        order = np.argsort(column)
        column, total = column[order], total[order]
        terms = held["term"].combine_chunks()
        coded = (terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms).dictionary_encode().indices.to_numpy()[~head]
        codes, row = np.unique(coded, return_inverse=True)
        place = np.searchsorted(column, number[~head])
        value = np.zeros((len(column), len(column)), dtype=np.int64)
        first = column // side == key[1]
        by = np.argsort(row, kind="stable")
        row, place, times = row[by], place[by], n[~head][by]
        step = max(1, (1 << 20) // max(len(column), 1))
        for lo in range(0, len(codes), step):
            a, b = np.searchsorted(row, (lo, lo + step))
            grid = np.zeros((len(column), min(step, len(codes) - lo)), dtype=np.int64)
            grid[place[a:b], row[a:b] - lo] = times[a:b]
            grid = scaled_array(grid + 2, total[:, None])
            for x in range(len(column)):
                # sources of one block meet each other, those of two only across
                across = np.arange(len(column)) > x if key[1] == key[2] else ~first & first[x]
                if across.any():
                    value[x, across] += gap(grid[x], grid[across]).sum(axis=1)
        x, y = np.nonzero(np.triu(np.ones_like(value), 1) if key[1] == key[2] else first[:, None] & ~first[None, :])
        some = len(x)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * some, pa.string()), pa.array(column[x]), pa.array(column[y]), pa.array(np.full(some, len(codes), dtype=np.int64)), pa.array(value[x, y])],
            names=["lang", "a", "b", "seen", "value"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = batch.column(0).to_pylist()
            rest = [batch.column(c).to_pylist() for c in (1, 2, 3)]
            names = list(zip(lang, *rest))
            cut = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cut, cut[1:]):
                if names[a] != now:
                    if held:
                        yield finish(now, pa.Table.from_batches(held))
                    now, held = names[a], []
                held.append(batch.slice(a, b - a).select(["term", "number", "n", "head"]))
        if held:
            yield finish(now, pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "lang string, a int, b int, seen bigint, value bigint")


def audit(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, text: str = "text", lang: str = "lang", source: str = "source",
          side: int = SIDE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has the other sources of the language, part
    ``term`` the first ``ranks`` kept terms that the source has oftener than its language."""
    named = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(text).alias("text"))

    counts = written(partial_counts(named).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    words = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
                    .select("lang", "term", "whole"), "kept_terms")
    kept = written(counts.drop("docs").join(words, ["lang", "term"]), "kept_counts")
    langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("whole").alias("lang_n"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    nil = F.lit(0).cast("bigint")
    groups = (named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("terms", nil).alias("terms"),
                      (F.coalesce("group_n", nil) + 2 * F.coalesce("terms", nil)).alias("total"),
                      (F.coalesce("lang_n", nil) + 2 * F.coalesce("terms", nil)).alias("lang_total")))
    # one row per group: sources of a language are numbered in order
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = written(groups.withColumn("number", F.row_number().over(by_name) - 1)
                     .withColumn("groups", F.count(F.lit(1)).over(Window.partitionBy("lang"))), "groups")

    sums = written(pair_sums(kept.select("lang", "source", "term", "n"), groups.where("terms > 0").select("lang", "source", "number", "groups", "total"),
                             side, shard_rows).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")), "pair_sums")
    mirrored = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "seen"))
    one = groups.select("lang", "source", F.col("number").alias("a"), "total", "terms")
    two = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("total").alias("other_total"))
    p, q = (scaled(F.lit(2).cast("bigint"), F.greatest(F.col(c), F.lit(1))) for c in ("total", "other_total"))
    unseen = (F.col("terms") - F.coalesce("seen", nil)) * _div((p - q) * (p - q), p + q)
    pairs = one.join(two, "lang").where("a <> b").join(mirrored, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("terms") > 0, F.coalesce("value", nil) + unseen).otherwise(nil).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    placed = kept.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"]).select(
        "lang", "source", "term", scaled(F.col("n") + 2, F.col("total")).alias("p"), scaled(F.col("whole") + 2, F.col("lang_total")).alias("q"))
    p, q = F.col("p"), F.col("q")
    terms = placed.where(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _div((p - q) * (p - q), p + q).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= ranks)
    return pairs.unionByName(terms)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of sources of a language, and the ten terms that mark each source most."""
    return audit(documents(spark, sf_dir))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (SELECT o.lang, o.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = o.lang AND c.source = o.source), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) o),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
      (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v.v))::HUGEINT AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, (1 + (1000000000::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v))::HUGEINT AS q FROM k JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM a)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
