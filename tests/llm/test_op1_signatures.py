"""Candidate signatures of the Jaccard join: what is frequent becomes stars before and after the shuffle."""

import numpy as np
import pytest

from tidelog.llm import op1_jaccard as op1


def test_combined_keeps_rare_rows_and_makes_stars_of_frequent_ones():
    rare = [(7, c, 256 * 40 + 3) for c in range(100, 100 + op1.FEW)]
    hot = [(9, c, 256 * 40 + 3) for c in range(200, 300)]
    rows = np.array(rare + hot + rare[:3] + hot[:5], dtype=np.int64)
    sig, keys, info = op1.combined(*rows.T)
    got = list(zip(sig.tolist(), keys.tolist(), info.tolist()))
    assert sorted(r for r in got if r[2] >= 0) == sorted(rare)
    assert [r for r in got if r[2] == op1.MANY] == [(9, 200, op1.MANY)]
    assert sorted(r for r in got if r[2] == op1.EDGE) == [(c, 200, op1.EDGE) for c in range(201, 300)]
    assert all(len(c) == 0 for c in op1.combined(*np.zeros((3, 0), dtype=np.int64)))


@pytest.mark.parametrize("held", [50, 1 << 20])
def test_clusters_of_a_hot_signature_do_not_depend_on_how_rows_are_cut(spark, monkeypatch, held):
    """A line that all texts share, groups of near copies, and rows dealt over many tasks and small batches."""
    rng = np.random.default_rng(5)
    texts = []
    for g in range(30):
        body = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        for _ in range(1 + g % 4 + 20 * (g == 7)):
            copy = list(body)
            copy[int(rng.integers(150))] = f"x{rng.integers(1 << 30)}"
            texts.append("one line that every text here has in common " + " ".join(copy))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "rid bigint, text string")
    monkeypatch.setattr(op1, "HELD", held)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {r.node: r.root for r in op1.candidate_clusters(docs.repartition(5), 5, 80).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # every similar pair is in one cluster
    sets = [{" ".join(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    keys = {r["rid"]: r["class"] for r in op1.sets_of(docs, 5).collect()}
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert len(links) > 200
    assert all(keys[i] == keys[j] or found[keys[i]] == found[keys[j]] for i, j in links)
    # and a cluster is named by one of its own classes
    assert all(found[root] == root for root in found.values())


def test_near_pairs_need_near_sizes():
    keys = np.arange(5, dtype=np.int64)
    info = np.array([100, 90, 70, 10, 10]) * 256 + np.array([9, 4, 6, 2, 3])
    (a, b, need), (c, d, other) = sorted(op1.near_pairs(keys, info, np.array([0, 3]), np.array([3, 2]), 80), key=lambda x: x[0].tolist())
    assert list(zip(a.tolist(), b.tolist(), need.tolist())) == [(0, 1, 4)]
    assert list(zip(c.tolist(), d.tolist(), other.tolist())) == [(3, 4, 2)]


def test_sets_leave_out_frequent_signatures_by_one_order():
    owner, sig, need = np.repeat([0, 1, 2], 4), np.array([1, 2, 3, 4, 2, 3, 4, 5, 3, 4, 5, 6], dtype=np.uint64), np.repeat([3, 2, 1], 4)
    often = np.array([0, 7, 9, 7])[(sig - np.uint64(1)) % np.uint64(4)]
    got = [list(map(int, r)) for r in zip(*op1.thinned(owner, sig, need, often))]
    assert got == [[0, 1, 1], [0, 4, 1], [1, 2, 1], [1, 4, 1], [1, 5, 1], [2, 3, 1], [2, 4, 1], [2, 5, 1], [2, 6, 1]]


def test_a_line_in_all_texts_makes_no_cluster(spark):
    rng = np.random.default_rng(8)
    line = "one line that every text here has in common "
    texts = [line + " ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 150)) for _ in range(200)]
    texts += [t + " more" for t in texts[:3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "rid bigint, text string")
    found = op1.candidate_clusters(docs, 5, 80).groupBy("root").count().collect()
    assert sorted(r["count"] for r in found) == [2, 2, 2]
