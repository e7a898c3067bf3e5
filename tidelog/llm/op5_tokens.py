"""Token counts by a map-side two-tier lookup.

A text's token count under a byte-level BPE is the sum over its pre-tokens.  Tier one is a compact
table ``pre-token -> token count``, built once on the driver from the tokenizer's own vocabulary (at
most ``table_size`` entries, so its broadcast has a fixed bound whatever the corpus).  Tier two is a
bounded cache in each Python worker: a pre-token that neither holds is encoded once by the tokenizer
library and remembered.  Pre-tokens are never shuffled; the job is one scan.

The split into pre-tokens must be the library's.  Its pattern is run by the ``regex`` package; texts
with a character that the two class differently (each worker compares them once for every distinct
character it meets), and texts that contain an added token's string, are encoded whole by the library
instead, so every count is the library's.

Defined cases: a null text is empty (0 bytes, 0 tokens); null ids stay null; rows that repeat are
counted one by one; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, documents

NAME = "op5_token_counts"
SQL = None

#: Entries of the broadcast table, and of one worker's cache of missed pre-tokens.
TABLE_SIZE = 65_536
CACHE_SIZE = 1_000_000
LIMIT = 512

#: Fixed value: the pattern by which byte-level tokenizer files of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text.  It travels with the task, so executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def agrees(tokenizer, find, char: str) -> bool:
    """Whether the library's splitter and the pattern class a character alike: it is put between letters,
    digits, marks and spaces, and the two lists of pre-token spans are compared."""
    probe = f"a{char}1{char}. {char}\n {char}{char}  a"
    return [s for _, s in tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == [m.span() for m in find(probe)]


def build_table(tokenizer, size: int = TABLE_SIZE) -> dict[str, int]:
    """Token counts of frequent pre-tokens: the vocabulary's own strings, which byte-pair training put
    there because they are frequent, in id order; only those that are one pre-token are kept."""
    import regex

    pattern = regex.compile(PATTERN)
    ids = [i for i in range(tokenizer.get_vocab_size(with_added_tokens=False))][:size]
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    whole = [t for t in texts if t and "�" not in t and pattern.fullmatch(t) and pattern.findall(t) == [t]]
    return dict(zip(whole, (len(e.ids) for e in tokenizer.encode_batch(whole, add_special_tokens=False))))


class Counts:
    """Counts tokens of texts in a worker: the shared table, then the cache, then the library."""

    def __init__(self, source: str, table: dict[str, int], cache_size: int = CACHE_SIZE):
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(source)
        added = [regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(added)) if added else None
        pattern = regex.compile(PATTERN)
        self.split, self.find = pattern.findall, pattern.finditer
        self.table, self.cache, self.cache_size = table, {}, cache_size
        self.alike: set[str] = set()
        self.unlike: set[str] = set()
        self._compare({chr(c) for c in range(128)})

    def _compare(self, chars: set[str]) -> None:
        for c in chars:
            (self.alike if agrees(self.tokenizer, self.find, c) else self.unlike).add(c)

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _by_library(self, text: str) -> bool:
        chars = set() if text.isascii() else set(text)
        if not chars <= self.alike:
            self._compare(chars - self.alike - self.unlike)
        if self.unlike and not self.unlike.isdisjoint(chars or text):
            return True
        return self.special is not None and self.special.search(text) is not None

    def count(self, text: str) -> int:
        if self._by_library(text):
            return self._encode([text])[0]
        total, missed = 0, []
        for piece, n in Counter(self.split(text)).items():
            size = self.table.get(piece) or self.cache.get(piece)
            if size is None:
                missed.append((piece, n))
            else:
                total += size * n
        if missed:
            sizes = self._encode([p for p, _ in missed])
            if len(self.cache) + len(missed) > self.cache_size:
                self.cache.clear()
            for (piece, n), size in zip(missed, sizes):
                self.cache[piece] = size
                total += size * n
        return total


_counters: dict[int, Counts] = {}


def _counter(shared, key: int) -> Counts:
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counts(*shared.value)
    return _counters[key]


def token_counts(docs: DataFrame, path: str | None = None, text: str = "text", id_col: str = "doc_id",
                 table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE) -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text."""
    from tokenizers import Tokenizer

    source = read_tokenizer(path or tokenizer_path())
    tokenizer = Tokenizer.from_str(source)
    shared = docs.sparkSession.sparkContext.broadcast(
        (source, build_table(tokenizer, table_size), cache_size))
    key = shared._jbroadcast.id()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared, key)
        column = batch.column(1)
        n_bytes = pc.cast(pc.fill_null(pc.binary_length(column), 0), pa.int64())
        n = pa.array([counter.count(t) if t else 0 for t in column.to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n], names=["doc_id", "n_bytes", "n_tokens"])

    return arrow_map(picked, run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under the 50k byte-level BPE."""
    counts = token_counts(documents(spark, sf_dir))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
