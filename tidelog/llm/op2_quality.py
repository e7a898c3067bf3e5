"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text.  The ledger row keeps the measurements and one failure bit per
rule; versioned policies are masks over the bits, so a new policy, or the effect of dropping one rule
(:func:`ablations`), is bitwise arithmetic over the ledger and never reads a text again.

The measurements are numpy passes over Arrow batches (word bounds, rolling fingerprints); one text
never leaves its task and nothing is shuffled.  Rolling fingerprints have 64 bits and are compared
only inside one text.

Defined cases: a null text counts as empty (no words: ``few_words`` fails); null ids stay null; rows
that repeat are measured one by one; an empty table gives an empty ledger; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, documents, flat, groups, per_text
from .rolling import Prefix, mix, word_bounds, word_prints

NAME = "op2_quality_rules"

#: Rules in bit order: name and failure condition over the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 5 * word_chars"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 14 * n_words"),
)

#: Policy versions: the rules that reject a text.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words"),
}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_WINDOW = 5


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def measure_texts(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of each text of a flat batch."""
    n = len(offsets) - 1
    start, end, first = word_bounds(buf, offsets)
    words = word_prints(buf, start, end)
    owner = np.repeat(np.arange(n), np.diff(first))
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))
    # code points are the bytes that do not continue one
    points = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    # lines with a word, as ranges of the buffer
    breaks = buf == 10
    begins = np.union1d(offsets[:-1], np.flatnonzero(breaks) + 1)
    begins = begins[begins < len(buf)]
    line_text = np.searchsorted(offsets, begins, side="right") - 1
    ends = np.append(begins[1:], len(buf))[:len(begins)]
    ends = np.minimum(ends - breaks[ends - 1], offsets[line_text + 1])
    has_word = np.searchsorted(start, ends) > np.searchsorted(start, begins)
    line_text, begins, ends = line_text[has_word], begins[has_word], ends[has_word]
    lines = mix(word_prints(buf, begins, ends) ^ salt[line_text])
    n_lines = np.bincount(line_text, minlength=n)
    _, kept = np.unique(lines, return_index=True)
    distinct = np.bincount(line_text[kept], minlength=n)
    # windows of five words that occur twice or more in their text
    repeat = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) >= _WINDOW:
        grams = Prefix(words).windows(_WINDOW)
        inside = np.flatnonzero(owner[:len(grams)] == owner[_WINDOW - 1:])
        hit = inside[_repeated(mix(grams[inside] ^ salt[owner[inside]]))]
        np.add.at(repeat, hit, 1)
        np.add.at(repeat, hit + _WINDOW, -1)
    return {
        "n_words": np.diff(first),
        "word_chars": per_text(points[end] - points[start], first),
        "n_symbols": per_text(_SYMBOLS[buf], offsets),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - distinct,
        "n_repeat_words": per_text(np.cumsum(repeat[:-1]) > 0, first),
    }


def _measure_batch(column) -> list[pa.Array]:
    buf, offsets = flat(column)
    parts = [measure_texts(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in groups(offsets)]
    return [pa.array(np.concatenate([p[m] for p in parts]).astype(np.int64)) for m in MEASURES]


def measured(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus one column per measurement, one row per input row."""
    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]),
                        *(f"{m} bigint" for m in MEASURES)])
    names = [*keep, *MEASURES]

    def run(batch):
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *_measure_batch(batch.columns[-1])], names=names)

    return arrow_map(source, run, fields)


def fail_bits(rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Failure bits from the measurements, rule ``i`` at bit ``i``."""
    bits = F.lit(0).cast("bigint")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return bits


def mask_of(policy: str | Sequence[str], rules: Sequence[tuple[str, str]] = RULES) -> int:
    names = [r for r, _ in rules]
    return sum(1 << names.index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def passes(policy: str | Sequence[str] = CURRENT, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Verdict of a policy on a ledger row."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy, rules)).cast("bigint")) == 0


def ledger(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
           rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """The ledger: ``keep`` columns, measurements and ``fail_bits``."""
    return measured(docs, text, keep).withColumn("fail_bits", fail_bits(rules))


def ablations(book: DataFrame, policy: str | Sequence[str] = CURRENT,
              rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Per rule of a policy: texts it fails, texts only it fails (they would come back without it) and
    texts the policy keeps without it.  One partial aggregate over the bits, no text is read again."""
    mask = mask_of(policy, rules)
    bits = book.select((F.col("fail_bits").bitwiseAND(F.lit(mask).cast("bigint"))).alias("b"))
    # texts with equal bits count together: at most 2 ** len(rules) rows leave this aggregate
    counted = bits.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    names = [r for r, _ in rules if mask & mask_of([r], rules)]
    rows = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r], rules)).cast("bigint").alias("m"))
                               for r in names)))
    return (counted.withColumn("r", rows)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("b").bitwiseAND(F.col("r.m")) != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("b") == F.col("r.m"), F.col("n")).otherwise(0)).alias("failed_alone"),
                 F.sum(F.when(F.col("b").bitwiseAND(F.lit(mask).cast("bigint") - F.col("r.m")) == 0, F.col("n"))
                       .otherwise(0)).alias("kept_without")))


def accepted(docs: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, all columns unchanged, in one pass without a join."""
    columns = list(docs.columns)
    renamed = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    at = f"c{columns.index(text)}"
    book = ledger(renamed.withColumn("__t", F.col(at)), "__t", renamed.columns)
    return book.where(passes(policy)).select(*renamed.columns).toDF(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all documents with the base verdict and the current policy's verdict."""
    book = ledger(documents(spark, sf_dir))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                       "fail_bits", (~passes("base")).alias("base_failed"), passes(CURRENT).alias("kept"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n
      FROM (SELECT rid, i, w[i:i + 4] AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d))),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM g, (SELECT unnest(range(0, 5)) AS k) WHERE n > 1 GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN r USING (rid)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN 100 * n_symbols > 5 * word_chars THEN 4 ELSE 0 END
                 + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
                 + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
                 + CASE WHEN word_chars > 14 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""
