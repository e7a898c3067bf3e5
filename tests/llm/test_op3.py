import hashlib
import math
import zlib

from tidelog.llm import op3_sharding as op


def brute(key, weights):
    def score(s, w):
        u = (int(hashlib.md5(f"{'null' if key is None else key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / w
    return min((score(s, w), s) for s, w in enumerate(weights) if w > 0)[1]


ROWS = [(i, f"text {i}" * (i % 7)) for i in range(400)] + [(None, "x"), (None, None), (5, None), (5, "é" * 100_000)] + [(7, "same")] * 300


def test_shards_slots_and_growth(spark):
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in ROWS], "doc_id long, text string, shard string, slot int")
    weights = (1.0, 2.0, 0.0, 1.5)
    got = op.shard(df, weights=weights, grown=(*weights, 1.0)).collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(
        str((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))) for i, t in ROWS)
    for r in got:
        assert r.shard == brute(r.doc_id, weights)
        assert r.grown_shard == brute(r.doc_id, (*weights, 1.0))
        assert r.grown_shard in (r.shard, 4)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    keys = {}
    for r in got:
        keys.setdefault(r.shard, []).append(r.slot)
    assert 2 not in keys and len(keys) == 3


def test_weights_draw_their_share(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text")
    n = {r["shard"]: r["count"] for r in df.select(op.shard_of(df.doc_id, (1.0, 3.0)).alias("shard")).groupBy("shard").count().collect()}
    assert abs(n[1] / 20_000 - 0.75) < 0.02


def test_empty_table(spark):
    assert op.shard(spark.createDataFrame([], "doc_id long, text string")).collect() == []
