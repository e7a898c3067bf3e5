import base64
import glob
import gzip
import hashlib
import os

import pytest

from tidelog.llm import op7_warc as op

ROWS = [(i, f"http://h/{i}", f"<p>{i % 40} " * (i % 90)) for i in range(300)] + [
    (1000, None, None), (1001, "u\r\nX: y", ""), (None, "n", "<p>3 " * 3), (None, None, "only null ids"), (None, "z", "only null ids"),
    (5, "again", "<p>5 " * 5), (2000, "é", "é\r\n\r\nWARC/1.1\r\n" * 50_000), (-7, "neg", "<p>7 " * 7), ((1 << 62) + 1, "big", "x"), (1 << 62, "big", "x")]


def want(rows):
    first = {}
    for i, _, p in rows:
        if i is not None:
            first[p or ""] = min(first.get(p or "", i), i)
    out = []
    for i, _, p in rows:
        b = (p or "").encode()
        f = first.get(p or "")
        revisit = f is not None and (i is None or i > f)
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return out


def key(t):
    return tuple((x is None, x) for x in t)


def test_round_trip_and_same_files_twice(spark, tmp_path):
    files = []
    for run, parts in enumerate((3, 7)):
        root = f"{tmp_path}/{run}"
        df = spark.createDataFrame([(*r, "x", 1) for r in ROWS[::-1 if run else 1]], "page_id long, url string, html string, shard string, kind int")
        manifest = op.write_warc(df.repartition(parts), root, shard_bytes=200_000, file_bytes=3_000)
        got = op.read_warc(spark, root, batch_bytes=1000).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want(ROWS), key=key)
        bodies = sorted(((r.page_id, bytes(r.payload)) for r in got if r.payload is not None), key=key)
        assert bodies == sorted(((i, (p or "").encode()) for (i, _, p), w in zip(ROWS, want(ROWS)) if w[3] == "response"), key=key)
        listed = {r.file: r.sha256 for r in manifest.collect()}
        found = {os.path.basename(f): hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{root}/*.warc.gz")}
        assert found == listed and len(listed) > 5 and len({f.split("-")[1] for f in listed}) > 2
        assert not glob.glob(f"{root}/_temporary/*")
        files.append(listed)
    assert files[0] == files[1]


def test_records_are_gzip_members_with_digests(spark, tmp_path):
    root = str(tmp_path / "w")
    op.write_warc(spark.createDataFrame(ROWS[:3], "page_id long, url string, html string"), root)
    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{root}/*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == 3 and text.endswith(b"\r\n\r\n")
    data = op.record(1, "u", b"abc", None)
    with pytest.raises(ValueError):
        op.parse(data.replace(b"abc", b"abd"))


def test_a_lost_attempt_and_a_changed_file(spark, tmp_path):
    root = str(tmp_path / "w")
    os.makedirs(f"{root}/_temporary")
    open(f"{root}/_temporary/shard-000000-0000.warc.gz.lost", "wb").write(b"half")
    df = spark.createDataFrame(ROWS[:20], "page_id long, url string, html string")
    op.write_warc(df, root)
    assert op.read_warc(spark, root).count() == 20
    file = glob.glob(f"{root}/*.warc.gz")[0]
    data = open(file, "rb").read()
    open(file, "wb").write(data + data[:0] + gzip.compress(op.record(9, "u", b"more", None), mtime=0))
    with pytest.raises(Exception, match="not the file of the manifest"):
        op.read_warc(spark, root).collect()


def test_small_payloads_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "long one"), (4, "d", "long one")], "page_id long, url string, html string")
    op.write_warc(df, f"{tmp_path}/a", min_revisit_bytes=5)
    assert {r.page_id: r.refers_to for r in op.read_warc(spark, f"{tmp_path}/a").collect()} == {1: None, 2: None, 3: None, 4: 3}
    op.write_warc(df.limit(0), f"{tmp_path}/b")
    assert op.read_warc(spark, f"{tmp_path}/b").collect() == []
