"""Deterministic sharded WARC writer and its reader.

Writing:

1. The payload digest of every page is grouped to its least page id (partial aggregate); pages with the
   same payload become ``revisit`` records of that page, joined by digest on narrow rows only.
2. Shard bounds are quantiles of a hash-chosen sample of the ids, so they only depend on the rows.
   Pages and revisit marks go to their shard in one shuffle and are sorted by id there.
3. A task writes its shard as gzip members, one for each record, regenerating headers, digests and
   record ids, and rolls to a new file when the compressed size is reached.  Files carry a temporary
   name of the attempt, so a lost or repeated task leaves nothing that counts.
4. The tasks' rows (file, size, SHA-256, records) are written as a manifest; a second job renames the
   files it lists to their final names and the final manifest is written last.

Same rows and settings give the same files, byte for byte: no clock, task or attempt enters a record.

Reading goes by the final manifest: each file is streamed record by record, the checksum of the file
and every digest is checked, and headers and payload are returned.

Defined cases: a null payload is empty; a null page id sorts last and its record has no page header
(read back as null); rows that repeat in id and payload get records of the same type; pages of equal
payload whose ids are all null are all responses; an empty table writes no file and reads back empty;
other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import scratch_dir

from .base import ship

NAME = "op7_warc"

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

DATE = "2000-01-01T00:00:00Z"
#: Compressed bytes of a file and payload bytes of a shard; for hundreds of terabytes pass some GB.
FILE_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
SAMPLE_PER_SHARD = 64
MIN_REVISIT_BYTES = 0

MANIFEST = "file string, temporary string, bytes bigint, records bigint, sha256 string"
RECORD = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record: a response with the payload, or a revisit (HTTP headers only) of ``refers_to``."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", date), ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A"))]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Page-Refers-To", str(refers_to))]
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(member: bytes) -> tuple:
    """A record's values in the order of ``RECORD``; raises if a digest or length does not hold."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.decode().split(": ", 1) for line in lines[1:])
    block, end = rest[:int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
    if end != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = lambda k: int(fields[k]) if k in fields else None
    return (number("Page-ID"), fields["WARC-Target-URI"], fields["WARC-Type"], digest, size, number("Page-Refers-To"), None if revisit else payload)


class Roller:
    """Writes members to files of about ``limit`` compressed bytes and lists them."""

    def __init__(self, root: str, limit: int):
        self.store, self.root = fs.FileSystem.from_uri(root)
        self.attempt, self.limit, self.out, self.rows = uuid.uuid4().hex, limit, None, []
        self.store.create_dir(f"{self.root}/_temporary", recursive=True)

    def write(self, shard: int, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        if self.out is None or self.shard != shard or self.size + len(member) > self.limit:
            part = self.part + 1 if self.out is not None and self.shard == shard else 0
            self.close()
            self.shard, self.part, self.size, self.records, self.sha = shard, part, 0, 0, hashlib.sha256()
            self.file = f"shard-{shard:06d}-{part:04d}.warc.gz"
            self.out = self.store.open_output_stream(f"{self.root}/_temporary/{self.file}.{self.attempt}", compression=None)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.file, f"_temporary/{self.file}.{self.attempt}", self.size, self.records, self.sha.hexdigest()))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_MANIFEST = pa.schema([("file", pa.string()), ("temporary", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()), ("sha256", pa.string())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                     ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def shard_bounds(pages: DataFrame, shard_bytes: int) -> np.ndarray:
    """Ids at which shards begin, for about ``shard_bytes`` of payload each: quantiles of the ids whose
    hash falls into a fixed share, about ``SAMPLE_PER_SHARD`` ids for each shard."""
    rows, size = pages.agg(F.count("page_id"), F.sum(F.octet_length("payload"))).first()
    shards = max(1, -(-int(size or 0) // shard_bytes))
    share = max(1, rows // (shards * SAMPLE_PER_SHARD))
    picked = pages.where(f"page_id IS NOT NULL AND pmod(xxhash64(page_id), {share}) = 0").select("page_id")
    ids = np.sort(np.array([r[0] for r in picked.collect()], dtype=np.int64)) if shards > 1 else np.zeros(0, np.int64)
    return np.unique(ids[np.arange(1, shards) * len(ids) // shards]) if len(ids) else ids


def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, sha, refers_to`` of the pages whose payload a page of smaller id has."""
    hashed = pages.where(F.octet_length("payload") >= min_bytes).select("page_id", "sha")
    first = hashed.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    return hashed.join(first.drop("n"), "sha").where("page_id IS NULL OR page_id > refers_to").select("page_id", "sha", "refers_to").distinct()


def write_warc(pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the archives under ``root`` (a folder all executors share) and return the final manifest."""
    spark = pages.sparkSession
    ship(spark)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    plain = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    plain = plain.withColumn("sha", F.sha1("payload"))
    bounds = spark.sparkContext.broadcast(shard_bounds(plain, shard_bytes))
    # marks sort before their pages: kind 0 before kind 1
    marks = revisits(plain, min_revisit_bytes).select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "sha", "refers_to", F.lit(0).alias("kind"))
    rows = marks.unionByName(plain.withColumns({"refers_to": F.lit(None).cast("bigint"), "kind": F.lit(1)}))
    schema = "shard int, page_id bigint, url string, payload binary, sha string, refers_to bigint, kind int"

    def place(batches):
        for batch in batches:
            ids = batch.column(0)
            shard = np.searchsorted(bounds.value, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right").astype(np.int32)
            shard[ids.is_null().to_numpy(zero_copy_only=False)] = len(bounds.value)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], names=["shard", *batch.schema.names])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (rows.mapInArrow(place, schema).repartition(n, "shard")
                   .sortWithinPartitions("shard", F.asc_nulls_last("page_id"), "sha", "kind", F.asc_nulls_first("url")))

    def write(batches):
        roller, mark = Roller(root, file_bytes), None
        for batch in batches:
            for i in range(batch.num_rows):
                shard, pid, link, body, sha, refers, kind = (batch.column(c)[i].as_py() for c in range(7))
                if kind == 0:
                    mark = (pid, sha, refers)
                else:
                    to = mark[2] if mark is not None and mark[:2] == (pid, sha) else None
                    roller.write(shard, record(pid, link, body, to))
        roller.close()
        yield _table(roller.rows, _MANIFEST)

    staged = f"{root}/_staged"
    sorted_rows.mapInArrow(write, MANIFEST).write.parquet(staged)

    def commit(batches):
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for file, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # a repeated task finds its file under the final name already
                if store.get_file_info(f"{base}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{base}/{temporary}", f"{base}/{file}")
            yield batch

    spark.read.parquet(staged).mapInArrow(commit, MANIFEST).drop("temporary").write.parquet(f"{root}/_manifest")
    return spark.read.parquet(f"{root}/_manifest")


def members(stream) -> Iterator[tuple[bytes, bytes]]:
    """Gzip members of a stream: (decompressed, compressed)."""
    data = b""
    while True:
        inflate, out, taken = zlib.decompressobj(wbits=31), io.BytesIO(), []
        while not inflate.eof:
            if not data:
                data = stream.read(1 << 20)
                if not data:
                    if taken:
                        raise ValueError("the file ends inside a record")
                    return
            out.write(inflate.decompress(data))
            taken.append(data[:len(data) - len(inflate.unused_data)])
            data = inflate.unused_data
        yield out.getvalue(), b"".join(taken)


def read_warc(spark: SparkSession, root: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """All records of the archives that the final manifest of ``root`` lists (columns of ``RECORD``)."""
    ship(spark)

    def read(batches):
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for file, records, sha in zip(*(batch.column(c).to_pylist() for c in range(3))):
                rows, held, count, check = [], 0, 0, hashlib.sha256()
                with store.open_input_stream(f"{base}/{file}", compression=None) as stream:
                    for text, raw in members(stream):
                        check.update(raw)
                        rows.append(parse(text))
                        held, count = held + len(text), count + 1
                        if held >= batch_bytes:
                            yield _table(rows, _RECORD)
                            rows, held = [], 0
                if (count, check.hexdigest()) != (records, sha):
                    raise ValueError(f"{file} is not the file of the manifest")
                if rows:
                    yield _table(rows, _RECORD)

    manifest = spark.read.parquet(f"{root}/_manifest").select("file", "records", "sha256")
    # one file at a time for each task
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "file").mapInArrow(read, RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    root = scratch_dir(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), root)
    return read_warc(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS x FROM p),
f AS (SELECT x, min(page_id) AS first FROM d GROUP BY x)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (list_reduce(list_transform(range(5 * i, 5 * i + 5), lambda b: ((('0x' || substr(x, 1 + b // 4, 1))::INTEGER >> (3 - b % 4)) & 1)),
                            lambda a, c: 2 * a + c))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (x)
"""
