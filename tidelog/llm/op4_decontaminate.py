"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts are compared as tokens: maximal runs of letters and digits, lower-cased.  A spaced seed hashes
the tokens at fixed offsets and ignores those between, so a hit survives substitutions at the ignored
places.  The masks are chosen so that every window of ``WINDOW`` aligned tokens with up to two
substitutions holds a hit; ``tests/llm`` proves it by enumeration.  An item shorter than ``WINDOW`` is
compared whole and has masks of its length (``short_masks``): as many blocks are left out as it may have
substitutions, in every choice, down to the whole item as one seed.  Documents get the masks of those
lengths only that the benchmark has.

1. The benchmark's seeds are joined with the seeds of all documents.  The benchmark side is broadcast
   only when its counted rows stay under ``BROADCAST_ROWS``; a larger one is joined by shuffle.
2. Hits become distinct (document, item, diagonal) triples: a partial aggregate, so a passage repeated
   in any number of documents gives one row for each.
3. Each diagonal is verified around its hits: the item and the document are laid side by side, and the
   pair counts if some window of ``WINDOW`` aligned tokens (the whole item, if that is shorter) agrees
   in at least ``PERCENT`` percent.

Defined cases: null texts and ids are handled (no tokens; the id stays null); items without tokens match
nothing; an item of one token is in every document that has the token; rows that repeat are reported once and
removed alike; an empty table on either side gives no overlap; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents, row_key

NAME = "op4_benchmark_decontamination"
WINDOW = 13
PERCENT = 80
#: Fixed masks: the compared offsets.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8))
BROADCAST_ROWS = 1_000_000


def token_hashes(text: str) -> Column:
    """Fingerprints of the tokens of a text column."""
    return F.expr(rf"transform(regexp_extract_all(lower(coalesce(`{text}`, '')), '[\\p{{L}}\\p{{N}}]+', 0), w -> xxhash64(w))")


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once for each row: a one-element explode keeps the optimizer
    from inlining the expression into the lambdas that read the column at every position."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def seeds(tokens: DataFrame, masks=MASKS) -> DataFrame:
    """Every seed of the ``tokens`` column: all other columns, ``pos`` and ``seed``."""
    others = [c for c in tokens.columns if c != "tokens"]
    arrays, starts = [], ["0"]
    for m, mask in enumerate(masks):
        span = mask[-1]
        picked = ", ".join(f"tokens[i + {o}]" for o in mask)
        arrays.append(f"IF(size(tokens) > {span}, transform(sequence(0, size(tokens) - {span + 1}), i -> xxhash64({m}, {picked})), array())")
        starts.append(f"{starts[-1]} + greatest(size(tokens) - {span}, 0)")
    # one explode for all masks; a seed's place is its index less that of its mask's first seed
    out = tokens.select(*others, F.expr(f"array({', '.join(starts[:-1])})").alias("__starts"), F.expr(f"concat({', '.join(arrays)})").alias("__seeds"))
    out = out.select(*others, "__starts", F.posexplode("__seeds").alias("__at", "seed"))
    place = F.col("__at")
    for m in range(1, len(masks)):
        place = F.when(F.col("__at") >= F.col("__starts")[m], F.col("__at") - F.col("__starts")[m]).otherwise(place)
    return out.select(*others, place.alias("pos"), "seed")


def short_masks(n: int, percent: int = PERCENT) -> list[tuple[int, tuple[int, ...]]]:
    """Masks for an item of ``n`` tokens that is compared whole, each with its place in the item: any
    substitutions that ``percent`` allows leave one of them intact."""
    errors = n + -n * percent // 100
    blocks = min(n, errors + 2) if errors else 1
    out = []
    for gone in combinations(range(blocks), errors):
        kept = [o for k in range(blocks) if k not in gone for o in range(n * k // blocks, n * (k + 1) // blocks)]
        out.append((kept[0], tuple(o - kept[0] for o in kept)))
    return out


def short_seeds(tokens: DataFrame, masks, lengths: list[int], percent: int) -> DataFrame:
    """As :func:`seeds` for the whole texts of the given lengths; ``masks`` has all their masks."""
    cases = []
    for n in lengths:
        one = (f"named_struct('pos', {at}, 'seed', xxhash64({masks.index(mask)}, {', '.join(f'tokens[{at + o}]' for o in mask)}))"
               for at, mask in short_masks(n, percent))
        cases.append(f"WHEN {n} THEN array({', '.join(one)})")
    others = [c for c in tokens.columns if c != "tokens"]
    return tokens.select(*others, F.explode(F.expr(f"CASE size(tokens) {' '.join(cases)} END")).alias("s")).select(*others, "s.pos", "s.seed")


def _bounded(side: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
             item_id: str = "item_id", window: int = WINDOW, percent: int = PERCENT, masks=MASKS) -> DataFrame:
    """One row for each document and item that overlap, on their best diagonal: ``rid`` (row key),
    ``doc_id``, ``item_id``, ``first_token`` (of the document), ``n_aligned``, ``n_matched`` tokens of the
    diagonal, and ``window_matched`` in the best window of ``n_window`` tokens."""
    items = benchmark.select(row_key(item_id, item_text).alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("__text"))
    items = held(items.dropDuplicates(["item"]), "tokens", token_hashes("__text")).drop("__text")
    plain = docs.select(row_key(id_col, text).alias("rid"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    sized = items.select("item", F.size("tokens").alias("n"), "tokens")
    wanted, masks = seeds(sized.where(F.col("n") >= window), masks), list(masks)
    # at most window - 1 lengths
    lengths = sorted(r.n for r in sized.where(F.col("n").between(1, window - 1)).select("n").distinct().collect())
    if lengths:
        masks += sorted({mask for n in lengths for _, mask in short_masks(n, percent)} - set(masks))
        wanted = wanted.unionByName(short_seeds(sized, masks, lengths, percent))
    wanted = wanted.select("item", "n", F.col("pos").alias("at"), "seed")
    rows = wanted.count()
    found = seeds(held(plain, "tokens", token_hashes("text")).select("rid", "tokens"), masks).join(_bounded(wanted, rows), "seed")
    diagonals = found.select("rid", "item", "n", (F.col("pos") - F.col("at")).alias("diagonal")).distinct()
    # lists are bounded by the document's own seeds and the items that hold them
    listed = diagonals.groupBy("rid").agg(F.collect_list(F.struct("item", "n", "diagonal")).alias("hits"))
    beside = held(plain.join(listed, "rid"), "tokens", token_hashes("text")).select("rid", "doc_id", F.explode(F.expr(
        "transform(hits, x -> struct(x.item AS item, x.diagonal AS diagonal, "
        "slice(tokens, greatest(x.diagonal, 0) + 1, x.n + least(x.diagonal, 0)) AS part))")).alias("hit"))
    sides = beside.select("rid", "doc_id", "hit.*").join(_bounded(items.withColumnRenamed("tokens", "item_tokens"), rows), "item")
    agree = held(sides, "same", F.expr(
        "zip_with(part, slice(item_tokens, greatest(-diagonal, 0) + 1, size(part)), (a, b) -> IF(a = b, 1, 0))"))
    width = F.expr(f"least({window}, size(item_tokens))")
    agree = agree.withColumn("n_window", width).where("size(same) >= n_window")
    agree = held(agree, "window_matched", F.expr(
        "array_max(transform(sequence(0, size(same) - n_window), i -> aggregate(slice(same, i + 1, n_window), 0, (s, x) -> s + x)))"))
    agree = agree.where(F.col("window_matched") * 100 >= F.col("n_window") * percent)
    best = agree.groupBy("rid", "doc_id", "item", "item_id").agg(F.max(F.struct(
        "window_matched", F.expr("aggregate(same, 0, (s, x) -> s + x)").alias("n_matched"), F.size("same").alias("n_aligned"),
        (-F.col("diagonal")).alias("back"), "n_window")).alias("b"))
    return best.select("rid", "doc_id", "item_id", F.greatest(-F.col("b.back"), F.lit(0)).cast("bigint").alias("first_token"),
                       F.col("b.n_aligned").cast("bigint").alias("n_aligned"), F.col("b.n_matched").cast("bigint").alias("n_matched"),
                       F.col("b.window_matched").cast("bigint").alias("window_matched"), F.col("b.n_window").cast("bigint").alias("n_window"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, all columns unchanged."""
    columns = list(docs.columns)
    names = [f"c{i}" for i in range(len(columns))]
    inner_text, inner_id = f"c{columns.index(text)}", f"c{columns.index(id_col)}"
    plain = docs.toDF(*names)
    bad = overlaps(plain, benchmark, inner_text, inner_id, **settings).select("rid").distinct()
    return plain.withColumn("rid", row_key(inner_id, inner_text)).join(bad, "rid", "left_anti").select(*names).toDF(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark text, with the items they hold."""
    return overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("rid")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
x AS (SELECT rid, i, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 2)) AS i FROM d)),
y AS (SELECT item, i, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT item, w, unnest(range(1, len(w) - 2)) AS i FROM b)),
h AS (SELECT DISTINCT rid, item, x.i - y.i AS diagonal FROM x JOIN y USING (g)),
s AS (SELECT rid, item, doc_id, item_id, diagonal, least(13, len(b.w)) AS k,
             list_transform(range(greatest(1, 1 + diagonal), least(len(d.w), len(b.w) + diagonal) + 1),
                            lambda p: CASE WHEN d.w[p] = b.w[p - diagonal] THEN 1 ELSE 0 END) AS same
      FROM h JOIN d USING (rid) JOIN b USING (item)),
v AS (SELECT *, list_max(list_transform(range(1, len(same) - k + 2), lambda i: list_sum(same[i:i + k - 1]))) AS best FROM s WHERE len(same) >= k),
r AS (SELECT *, list_sum(same) AS m, row_number() OVER (PARTITION BY rid, item ORDER BY best DESC, list_sum(same) DESC, len(same) DESC, diagonal) AS o
      FROM v WHERE 100 * best >= 80 * k)
SELECT DISTINCT doc_id, item_id, greatest(diagonal, 0)::BIGINT AS first_token, len(same)::BIGINT AS n_aligned, m::BIGINT AS n_matched,
       best::BIGINT AS window_matched, k::BIGINT AS n_window FROM r WHERE o = 1
"""
