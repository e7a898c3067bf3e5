import hashlib
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import anchors, op9_substring as op
from tidelog.llm.base import flat

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    docs = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def corpus():
    rng = np.random.default_rng(7)

    def prose(n, vocabulary=400):
        return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))

    passage, long = prose(30), prose(60)
    texts = [prose(40) + " " + passage + "\n" + prose(20) for _ in range(6)]
    texts += [prose(5) + " " + long[:len(long) // 2] + " " + prose(9), long, long + " " + prose(3), prose(7) + "  " + long]
    texts += [prose(50)] * 4 + ["a b " * 60, "a " * 45, "a b " * 9, None, "", "one", prose(11), "é ü " * 40, prose(4000, 6)]
    return texts


def test_equals_brute_force(spark):
    texts = corpus()
    rows = [(i, t, "clash", 3) for i, t in enumerate(texts)] + [(None, "null id " + "x y z " * 9, "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, rid int").repartition(5)
    for window, seed in ((12, 4), (35, 10)):
        got = op.deduplicate(df, window, seed).toPandas()
        got.columns = ["doc_id", "text", "kept0", "rid", "n_words", "n_removed", "spans", "kept"]
        want = brute([t for _, t, *_ in rows], window)
        for r in got.itertuples():
            i = len(texts) if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id)
            assert (r.n_words, r.n_removed, r.kept) == want[i], i
            assert sum(s["end"] - s["first"] for s in r.spans) == r.n_removed


def test_repeated_rows_are_documents_of_their_own(spark):
    text = " ".join(f"u{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (1, text), (2, "short text")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in op.deduplicate(df).collect())
    assert got == [(1, 50), (1, 50), (2, 0)]


def test_equal_rows_list_their_runs_once(spark):
    docs = spark.createDataFrame([(1, "t")] * 5 + [(2, "u")], "rid long, text string")
    runs_of = spark.createDataFrame([(1, r) for r in (3, 4, -5)] * 5 + [(2, 3)], "rid long, run long").repartition(4)
    got = sorted((r.rid, sorted(r.runs)) for r in anchors.with_runs(docs, runs_of).collect())
    assert got == [(1, [-5, 3, 4])] * 5 + [(2, [3])]


def test_equal_rows_with_null_ids_equal_brute_force(spark):
    texts = [corpus()[6]] * 30 + corpus()[5:9]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(4)
    got = sorted((r.n_words, r.n_removed, r.kept) for r in op.deduplicate(df, 12, 4).collect())
    assert got == sorted(brute(texts, 12))


def test_empty_table(spark):
    assert op.deduplicate(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=80), min_size=1, max_size=5), st.integers(1, 50))
def test_every_window_is_in_one_run(texts, piece):
    import pyarrow as pa

    buf, offsets = flat(pa.array(texts))
    values, first = anchors.words(buf, offsets)
    old, anchors.PIECE = anchors.PIECE, piece
    try:
        got = sorted((int(o), int(b) + k) for owner, run, *_ in anchors.runs(values, first, 5, 2)
                     for o, b, s in zip(owner, anchors.unpack(run)[0], anchors.unpack(run)[2]) for k in range(s))
    finally:
        anchors.PIECE = old
    n = np.diff(first)
    assert got == [(t, i) for t in range(len(texts)) for i in range(max(0, n[t] - 4))]
