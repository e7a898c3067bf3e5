"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and their log scores come from a SentencePiece model file (never trained here).  They are
packed into a double-array trie over UTF-8 bytes on the driver; its size is that of the model, so the
broadcast is bounded.  A text is normalised by the model's own flags (white-space marker, marker
before the text), cut where a marker follows another character - no piece may cross such a place,
which is checked on loading - and each part is encoded by Viterbi: the best sum of log scores, of
equal sums the path whose last piece is longest.  A character without a piece costs the least score
minus 10 and becomes byte pieces.  Parts repeat, so each worker keeps a bounded cache of them; the parts
of some texts that it lacks are encoded side by side, one position of all of them after the other.

Decoding joins the pieces, turns byte pieces back into UTF-8 (invalid bytes read U+FFFD), markers into
spaces and drops the marker that encoding put first.

Defined cases: a null or empty text has no pieces and decodes to an empty text; a text that holds the
marker character itself decodes with a space in its place (``round_trip`` is false); null ids stay
null; rows that repeat are encoded one by one; other columns are not read; very long texts are encoded
part by part, and a part without markers in memory linear in its length.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, documents, kept, per_text

NAME = "op8_sentencepiece"
SQL = None
MARK = "▁"
UNKNOWN_COST = 10.0
CACHE_SIZE = 500_000
CACHED_PART = 64
#: Parts looked up at once, bytes of a block of parts encoded side by side, and fewest parts of a block.
LOOKUP, BLOCK_BYTES, BLOCK_PARTS = 1 << 16, 1 << 17, 24
#: Bytes of a character by its first byte; 0 for other bytes.
WIDTH = np.array([1] * 0x80 + [0] * 0x42 + [2] * 0x1E + [3] * 0x10 + [4] * 5 + [0] * 11, dtype=np.int64)
PAD = 0xFF


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Trie:
    """Double-array trie: from node ``s`` the byte ``c`` leads to ``t = base[s] + c + 1`` if
    ``check[t] == s``; ``value[t]`` is the id of the key that ends there, or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        tree: dict = {}
        for key, number in keys:
            node = tree
            for c in key:
                node = node.setdefault(c, {})
            node[-1] = number
        size = 1 << 10
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        pending, search_from = [(0, tree)], 1
        while pending:
            at, node = pending.pop()
            value[at] = node.get(-1, -1)
            children = sorted(c for c in node if c >= 0)
            if not children:
                continue
            first, taken = search_from, 0
            slot = first
            while True:
                start = slot - children[0] - 1
                if start + 257 >= len(check):
                    more = max(len(check), start + 258 - len(check))
                    base += [0] * more
                    check += [-1] * more
                    value += [-1] * more
                if check[slot] >= 0:
                    taken += 1
                elif start >= 0 and all(check[start + c + 1] < 0 for c in children):
                    break
                slot += 1
            # a stretch that is nearly full is not searched again
            if taken >= 0.9 * (slot - first + 1) or slot - first > 4096:
                search_from = slot
            base[at] = start
            for c in children:
                check[start + c + 1] = at
                pending.append((start + c + 1, node[c]))
        self.base, self.check, self.value = base, check, value


class Model:
    """What encoding and decoding need of a model file; plain lists, so that it can be broadcast."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kind = proto.SentencePiece
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that keep the text as it is are supported")
        self.dummy_prefix = norm.add_dummy_prefix
        normal = [(i, p) for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL]
        if any(p.type == kind.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        if any(MARK in p.piece.lstrip(MARK) for _, p in normal):
            raise ValueError("a piece has a marker after another character")
        self.scores = [p.score if p.type == kind.NORMAL else 0.0 for p in proto.pieces]
        self.unknown_score = min(p.score for _, p in normal) - UNKNOWN_COST
        self.unknown_id = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        self.byte_ids = [-1] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self.byte_fallback = min(self.byte_ids) >= 0
        self.trie = Trie([(p.piece.encode(), i) for i, p in normal])
        surface = {kind.UNKNOWN: " ⁇ ", kind.CONTROL: "", kind.UNUSED: ""}
        self.surfaces = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else
                         surface.get(p.type, p.piece.replace(MARK, " ")).encode() for p in proto.pieces]

    def viterbi(self, part: bytes) -> list[int]:
        """Best pieces of one part of a normalised text."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n = len(part)
        best = [-np.inf] * (n + 1)
        best[0], came, piece = 0.0, [0] * (n + 1), [0] * (n + 1)
        i = 0
        while i < n:
            lead = part[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, node, j, single = best[i], 0, i, False
            while j < n:
                after = base[node] + part[j] + 1
                if check[after] != node:
                    break
                node, j = after, j + 1
                number = value[node]
                if number >= 0:
                    single = single or j - i == width
                    if here + scores[number] > best[j]:
                        best[j], came[j], piece[j] = here + scores[number], i, number
            if not single and here + self.unknown_score > best[i + width]:
                best[i + width], came[i + width], piece[i + width] = here + self.unknown_score, i, self.unknown_id
            i += width
        out, j = [], n
        while j:
            i = came[j]
            if piece[j] == self.unknown_id and self.byte_fallback:
                out += [self.byte_ids[c] for c in reversed(part[i:j])]
            else:
                out.append(piece[j])
            j = i
        return out[::-1]


class Codec:
    """A worker's encoder with its cache of parts, and its decoder."""

    def __init__(self, model: Model, cache_size: int = CACHE_SIZE):
        import re

        self.model, self.cache, self.cache_size = model, {}, cache_size
        self.parts = re.compile(" +[^ ]*|[^ ]+").findall
        self.scores = np.array(model.scores)
        self.ends = np.append(self.scores, -np.inf)  # by id of the piece that ends at a node, -1 if none
        trie = model.trie
        self.first, self.check, self.value = np.array(trie.base) + 1, np.array(trie.check), np.array(trie.value)
        self.byte_ids = np.array(model.byte_ids)
        self.byte_of = np.full(len(model.scores), -1)
        for c, i in enumerate(model.byte_ids):
            if i >= 0:
                self.byte_of[i] = c

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Pieces of each text.  A part's marker is a space here and becomes one only where it is encoded."""
        first = " " if self.model.dummy_prefix else ""
        split = [self.parts(first + t.replace(MARK, " ")) if t else [] for t in texts]
        flat, found, cache = list(itertools.chain.from_iterable(split)), [], self.cache
        for at in range(0, len(flat), LOOKUP):
            some = flat[at:at + LOOKUP]
            known = {p: cache.get(p) for p in dict.fromkeys(some)}
            new = [p for p, ids in known.items() if ids is None]
            known.update(zip(new, self._solve([p.replace(" ", MARK).encode() for p in new])))
            if len(cache) + len(new) > self.cache_size:
                cache.clear()
            cache.update((p, known[p]) for p in itertools.islice(new, self.cache_size) if len(p) <= CACHED_PART)
            found += map(known.__getitem__, some)
        bounds = list(itertools.accumulate(map(len, split), initial=0))
        return [np.frombuffer(b"".join(found[i:j]), dtype=np.int32) for i, j in itertools.pairwise(bounds)]

    def _solve(self, parts: list[bytes]) -> list[bytes]:
        """Pieces of each part, as 32-bit integers.  Parts of like length are a block; of those too long to be
        many in a block, each is encoded alone."""
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        out, at = [b""] * len(parts), 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(parts[order[to]]) <= BLOCK_BYTES:
                to += 1
            block = order[at:to]
            if len(block) < BLOCK_PARTS:
                solved = [np.array(self.model.viterbi(parts[i]), dtype=np.int32).tobytes() for i in block]
            else:
                solved = self._side_by_side([parts[i] for i in block])
            for i, ids in zip(block, solved):
                out[i] = ids
            at = to
        return out

    def _side_by_side(self, parts: list[bytes]) -> list[bytes]:
        """``Model.viterbi`` of many parts of like length, the same comparisons in the same order."""
        first, check, value, ends, unknown = self.first, self.check, self.value, self.ends, self.model.unknown_score
        n, rows = len(parts[-1]), len(parts)
        text = np.frombuffer(b"".join(p.ljust(n, bytes([PAD])) for p in parts), dtype=np.uint8).reshape(rows, n).T.astype(np.int64)
        best = np.full((n + 1, rows), -np.inf)
        best[0] = 0.0
        came, piece = np.zeros((n + 1, rows), dtype=np.int32), np.zeros((n + 1, rows), dtype=np.int32)
        for i in range(n):
            width = WIDTH[text[i]]
            row = start = np.flatnonzero(width)
            here, node, j, single = best[i].take(row), np.zeros(len(row), dtype=np.int64), i, np.zeros(rows, dtype=bool)
            while len(row) and j < n:
                after = first.take(node) + text[j].take(row)
                go = np.flatnonzero(check.take(after) == node)
                row, here, node, j = row.take(go), here.take(go), after.take(go), j + 1
                number = value.take(node)
                if j - i <= 4:
                    single[row[(number >= 0) & (width.take(row) == j - i)]] = True
                sums = here + ends.take(number, mode="wrap")
                better = np.flatnonzero(sums > best[j].take(row))
                at = row.take(better)
                best[j][at], came[j][at], piece[j][at] = sums.take(better), i, number.take(better)
            row = start[~single[start]]
            if len(row):
                to, sums = i + width[row], best[i, row] + unknown
                better = sums > best[to, row]
                to, at = to[better], row[better]
                best[to, at], came[to, at], piece[to, at] = sums[better], i, self.model.unknown_id
        row, j, steps = np.arange(rows), np.array([len(p) for p in parts]), []
        while len(row):
            i = came[j, row]
            steps.append((row, piece[j, row], i, j - i))
            row, j = row[i > 0], i[i > 0]
        row, ids, i, width = (np.concatenate(x[::-1]) for x in zip(*steps))
        order = np.argsort(row, kind="stable")
        row, ids, i, width = row[order], ids[order], i[order], width[order]
        if self.model.byte_fallback and (ids == self.model.unknown_id).any():
            raw = ids == self.model.unknown_id
            each = np.where(raw, width, 1)
            place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            row, raw = np.repeat(row, each), np.repeat(raw, each)
            ids, place = np.repeat(ids, each), np.repeat(i, each) + place
            ids[raw] = self.byte_ids[text[place[raw], row[raw]]]
        bounds = np.searchsorted(row, np.arange(rows + 1)) * 4
        data = ids.astype(np.int32).tobytes()
        return [data[i:j] for i, j in itertools.pairwise(bounds.tolist())]

    def score(self, ids: np.ndarray) -> float:
        """Log score of the path: pieces, and one cost for each character that became bytes."""
        raw = self.byte_of[ids]
        unknown = np.count_nonzero((raw >= 0) & ((raw & 0xC0) != 0x80)) + np.count_nonzero(ids == self.model.unknown_id)
        return float(self.scores[ids].sum() + unknown * self.model.unknown_score)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.model.surfaces.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


#: All of this operator's tasks name it, so that none drops the codec another one goes on with.
OPERATOR = "op8"
_codecs: dict[int, Codec] = kept(OPERATOR)


def _codec(shared, key: int, cache_size: int) -> Codec:
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value, cache_size)
    return _codecs[key]


def _without_parts() -> None:
    """A worker that no longer encodes keeps no parts: a task has a worker for each of its steps, and any of them
    may have encoded before."""
    for codec in _codecs.values():
        codec.cache.clear()


@functools.lru_cache(maxsize=4)
def load(path: str) -> Model:
    return Model(path)


def _shared(spark: SparkSession, path: str | None):
    shared = spark.sparkContext.broadcast(load(path or model_path()))
    return shared, shared._jbroadcast.id()


def _ids_column(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else [], pa.int32()))


def _some(batch: pa.RecordBatch, text: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text, so that pieces of few texts are held at once."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def encode(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           cache_size: int = CACHE_SIZE) -> DataFrame:
    """``keep`` columns, ``ids`` (piece ids of the whole text) and ``log_score``."""
    shared, key = _shared(docs.sparkSession, path)
    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), "ids array<int>, log_score double"])

    def run(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, key, cache_size)
        for batch in _some(whole, len(keep)):
            parts = codec.encode_all(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _ids_column(parts), pa.array([codec.score(p) for p in parts], pa.float64())],
                                             names=[*keep, "ids", "log_score"])

    return arrow_map(source, run, fields, OPERATOR)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and ``out``, the text that the pieces in ``ids`` spell."""
    shared, key = _shared(encoded.sparkSession, path)
    at_ids, names = encoded.columns.index(ids), [*encoded.columns, out]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), f"`{out}` string"])

    def run(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _without_parts()
        codec = _codec(shared, key, CACHE_SIZE)
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            texts = [codec.decode(np.asarray(x.values)) if x.is_valid else "" for x in batch.column(at_ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return arrow_map(encoded, run, fields, OPERATOR)


def digests(decoded: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``n_byte_tokens`` and ``ids_sha256`` (of the ids as little-endian
    32-bit integers) of the ``ids`` column."""
    byte_ids = np.array(load(path or model_path()).byte_ids)
    source = decoded.select(*keep, "ids")
    names = [*keep, "n_tokens", "n_byte_tokens", "ids_sha256"]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]),
                        "n_tokens bigint, n_byte_tokens bigint, ids_sha256 string"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _without_parts()
        rows = [np.asarray(x.values).astype("<i4") if x.is_valid else np.zeros(0, "<i4") for x in batch.column(len(keep))]
        sizes = [len(r) for r in rows]
        bounds = np.cumsum([0, *sizes])
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:-1], pa.array(sizes, pa.int64()),
            pa.array(per_text(np.isin(np.concatenate(rows), byte_ids), bounds), pa.int64()),
            pa.array([hashlib.sha256(r.tobytes()).hexdigest() for r in rows])], names=names)

    return arrow_map(source, run, fields, OPERATOR)


def summary(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every text: id, digests of the pieces, ``log_score`` and ``round_trip`` (the
    decoded text is the text)."""
    source = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    both = decode(encode(source, path, keep=("doc_id", "text")), path)
    same = both.withColumn("round_trip", F.col("decoded") == F.col("text"))
    return digests(same, path, keep=("doc_id", "log_score", "round_trip"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, and whether they decode to the text."""
    return summary(documents(spark, sf_dir))
