import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import op13_runs as op
from tidelog.llm.base import flat
from tidelog.llm.rolling import word_bounds, word_prints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, repeats=3):
    """Every maximal stretch of every period, then those whose smallest period it is."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(least, repeats * q):
                smaller = any(all(words[k] == words[k - r] for k in range(start + r, start + length)) for r in range(1, q))
                if not smaller:
                    found.append((start, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 3), st.integers(3, 12))
def test_runs_equal_brute_force(words, repeats, least):
    assert op.runs_of(words, least, repeats) == brute(words, least, repeats)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=12), st.integers(1, 14)), max_size=5))
def test_stretches_lose_no_run(blocks):
    import pyarrow as pa

    words = [f"w{x}" for block, times in blocks for x in block * times]
    buf, offsets = flat(pa.array([" ".join(words), "u v " * 20]))
    start, end, first = word_bounds(buf, offsets)
    found = []
    for a, b in zip(*op.stretches(word_prints(buf, start, end), first)):
        if b <= first[1]:
            found += [(int(a) + s, n, q) for s, n, q in op.runs_of(op.numbered(words[a:b]))]
        else:
            assert (a, b) == (first[1], first[2])
    assert sorted(found, key=lambda r: (r[0], r[2])) == brute(words)


def test_accesses_recolour_paths():
    parent = [0, 0, 1, 2, 2, 1]
    paths = op.Paths(parent)
    assert paths.access(3, 10) == []
    assert paths.access(4, 11) == [(10, 2)]
    assert paths.access(3, 12) == [(10, 3), (11, 2)]
    assert paths.access(5, 13) == [(12, 1)]
    assert paths.access(4, 14) == [(11, 4), (12, 2), (13, 1)]


def corpus():
    rng = np.random.default_rng(11)
    prose = lambda n, v=50: [f"w{x}" for x in rng.integers(0, v, n)]
    line = prose(9)
    texts = [prose(300), prose(20) + line * 5 + prose(30), line * 3, line[:8] * 3, line[:7] * 3, ["a"] * 23, ["a"] * 24, ["a"] * 5000,
             (["a"] * 30 + ["b"]) * 4 + ["c"] * 40, prose(2000, 3), (prose(400) * 3)[:1205], ["x", "y"] * 12 + line + ["x", "y"] * 12,
             ["é", "ü"] * 30, line * 4 + line[:4] + prose(5) + line * 4]
    return ["  ".join(t) if i % 2 else "\n".join(t) + "\t" for i, t in enumerate(texts)] + [None, "", " \t", "one", "z" * 100_000]


def test_equals_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(None if i == 2 else i, t, "clash", 1) for i, t in enumerate(texts)] + [(1, texts[1], "clash", 1)],
                               "doc_id long, text string, runs string, c0 int").repartition(4)
    got = op.find_runs(df).toPandas()
    got.columns = ["doc_id", "text", "clash", "c0", "n_words", "runs", "collapsed"]
    assert len(got) == len(texts) + 1 and (got.clash == "clash").all()
    for r in got.itertuples():
        words = WORD.findall(r.text or "")
        want = brute(words) if len(set(words)) != 1 or len(words) < 100 else [(0, len(words), 1)]
        assert [(s["start"], s["length"], s["period"]) for s in r.runs] == want
        assert (r.n_words, r.collapsed) == (len(words), collapse(words, want))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = [r for r in brute(words)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapse(words, runs)))


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    short = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 9000]
    made = [(10_000 + i, t) for i, t in enumerate(corpus()[:4] * 12)] + [(20_000 + i, None) for i in range(12)] + [(30_000 + i, "a b c") for i in range(12)]
    spark.createDataFrame(short + made, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op.query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected(d, t) for d, t in short + made)


def test_empty_table(spark):
    assert op.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
