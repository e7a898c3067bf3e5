"""Flush groups against a greedy walk; serialized sizes; message logs."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.operators import messages as msg
from tidelog.operators.flush import flush_groups
from tidelog.session import scratch_dir


def greedy(sizes, budget):
    """(part, grp, first_off, last_off, n, bytes, accounted) by walking each partition's messages."""
    out = []
    for part in sorted({p for p, _, _ in sizes}):
        grp, cur = 0, []
        for off, size in sorted((o, s) for p, o, s in sizes if p == part):
            size = size or 0
            if cur and sum(min(s, budget) for _, s in cur) + min(size, budget) > budget:
                out.append((part, grp, cur[0][0], cur[-1][0], len(cur), sum(s for _, s in cur), sum(min(s, budget) for _, s in cur)))
                grp, cur = grp + 1, []
            cur.append((off, size))
        out.append((part, grp, cur[0][0], cur[-1][0], len(cur), sum(s for _, s in cur), sum(min(s, budget) for _, s in cur)))
    return out


def _groups(spark, sizes, budget, block_bytes=None):
    df = spark.createDataFrame(sizes, "part INT, off BIGINT, size BIGINT")
    return rows(flush_groups(df, F.col("size"), budget, block_bytes))


def test_one_message_of_the_whole_budget_each(spark):
    data = spark.createDataFrame([(0, 0, b"one"), (0, 1, b"two")], "part INT, off BIGINT, payload BINARY")
    m = msg.to_messages(data, F.col("payload"), F.col("part"), keep=["off"])
    assert [r[0] for r in m.select(msg.serialized_size(m)).collect()] == [5, 5]
    assert [r["n"] for r in flush_groups(m, msg.serialized_size(m), 5).collect()] == [1, 1]
    assert [r["n"] for r in flush_groups(m, msg.serialized_size(m), 10).collect()] == [2]


def test_groups_equal_the_greedy_walk_over_many_blocks(spark):
    rng = random.Random(3)
    sizes = [(0 if rng.random() < .7 else rng.randrange(1, 4), i * 3, rng.choice([0, None, 1, 5, 5, 9, 20, 33, 90])) for i in range(400)]
    want = greedy(sizes, 40)
    assert _groups(spark, sizes, 40, block_bytes=100) == want        # some 50 blocks in partition 0
    assert _groups(spark, sizes, 40, block_bytes=40) == want         # the smallest block allowed
    assert _groups(spark, sizes, 40) == want                         # one block


def test_edges(spark):
    assert _groups(spark, [], 10) == []
    assert _groups(spark, [(2, 7, None)], 10) == [(2, 0, 7, 7, 1, 0, 0)]
    assert _groups(spark, [(0, i, 0) for i in range(5)], 1, 1) == [(0, 0, 0, 4, 5, 0, 0)]
    big = [(0, i, 1000) for i in range(5)]
    assert _groups(spark, big, 10, 10) == greedy(big, 10)


def _wire(key, data, attributes, ms):
    """The bytes of a message in wire form, written out."""
    def varint(n):
        n &= (1 << 64) - 1
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, body):
        return bytes([number << 3 | 2]) + varint(len(body)) + body
    out = (field(1, key) if key else b"") + (field(2, data) if data else b"")
    for name, values in attributes.items():
        out += field(3, field(1, name.encode()) + field(2, b"".join(field(1, v) for v in values)))
    if ms is not None:
        s, n = ms // 1000, ms % 1000 * 1_000_000
        out += field(4, (b"\x08" + varint(s) if s else b"") + (b"\x10" + varint(n) if n else b""))
    return out


def test_serialized_size_equals_the_written_bytes(spark):
    cases = [(b"", b"", {}, None), (b"k", b"\xff\x00" * 70, {"a": [b"", b"\xfe"], "é": []}, 0), (b"", b"x" * 20000, {"n": [b"y" * 200]}, 1_700_000_000_123),
             (b"z" * 127, b"z" * 128, {"": [b""]}, -1500), (b"", b"", {}, 999)]
    df = spark.createDataFrame([(i, k, d, a, t) for i, (k, d, a, t) in enumerate(cases)],
                               "i INT, k BINARY, d BINARY, a MAP<STRING,ARRAY<BINARY>>, t BIGINT")
    from tidelog.functions.timestamps import from_epoch_ms

    m = msg.to_messages(df, F.col("d"), F.col("i"), F.col("k"), F.col("a"), from_epoch_ms(F.col("t")))
    got = {r[0]: r[1] for r in m.select("part", msg.serialized_size(m)).collect()}
    assert got == {i: len(_wire(*c)) for i, c in enumerate(cases)}


def test_bytes_and_attribute_order_survive_the_log(spark):
    df = spark.createDataFrame([(0, b"\xff\xfe", {"a": [b"2", b"1", b"\xff"]}), (1, None, None)],
                               "i INT, d BINARY, a MAP<STRING,ARRAY<BINARY>>")
    m = msg.to_messages(df, F.col("d"), F.lit(0), key=F.col("d"), attributes=F.col("a"), keep=["i"])
    path = scratch_dir(spark, "messages")
    msg.write_messages(msg.publish_messages(m, ["i"], 5, 1), path)
    back = {r["off"]: r for r in msg.read_messages(spark, path).collect()}
    assert bytes(back[0]["data"]) == bytes(back[0]["key"]) == b"\xff\xfe"
    assert [bytes(v) for v in back[0]["attributes"]["a"]] == [b"2", b"1", b"\xff"]
    assert bytes(back[1]["data"]) == b"" and back[1]["attributes"] == {}
