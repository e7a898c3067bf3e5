from collections import Counter

import numpy as np
import pytest

from tidelog.llm import op10_suffix as op


def brute(texts, window):
    docs = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + window] for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - window + 1):
            if seen[d[i:i + window]] > 1:
                gone[i:i + window] = True
        spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(d) else 0
        out.append((len(d), int(gone.sum()), spans, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def corpus():
    rng = np.random.default_rng(3)

    def prose(n, letters="abcdefgh "):
        return "".join(rng.choice(list(letters), n))

    passage, long = prose(120), prose(450)
    texts = [prose(90) + passage + prose(50) for _ in range(6)]
    texts += [prose(30) + long[:230] + prose(25), long, long + prose(5), prose(8) + long, "é" + long[100:330] + "ü"]
    texts += [prose(300)] * 4 + ["ab" * 400, "a" * 260, "a" * 150, None, "", "x", "é" * 180, prose(3000, "ab")]
    # one passage between many different neighbours
    texts += [prose(20) + passage[:60] + prose(20) for _ in range(80)]
    return texts


@pytest.mark.parametrize("window, lengths", [(50, (12, 25, 46, 50)), (50, (20, 50)), (200, op.LENGTHS)])
def test_equals_brute_force(spark, window, lengths):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "clash", 3) for i, t in enumerate(texts)] + [(None, "null id" * 40, "c", 1)],
                               "doc_id long, text string, kept string, rid int").repartition(5)
    got = op.deduplicate(df, window, lengths).toDF("doc_id", "text", "kept0", "rid0", "n_bytes", "n_removed", "spans", "kept").collect()
    want = brute([*texts, "null id" * 40], window)
    assert len(got) == len(want)
    for r in got:
        i = len(texts) if r.doc_id is None else r.doc_id
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[i], i


def test_repeated_rows_and_empty_table(spark):
    text = "".join(chr(65 + i % 61) + str(i) for i in range(100))
    df = spark.createDataFrame([(1, text), (1, text), (2, "short text")], "doc_id long, text string")
    assert sorted((r.doc_id, len(r.kept)) for r in op.deduplicate(df).collect()) == [(1, 0), (1, 0), (2, 10)]
    assert op.deduplicate(df.limit(0)).collect() == []


def test_lengths_must_grow_to_the_window(spark):
    with pytest.raises(ValueError):
        op.repeats(spark.createDataFrame([(1, "x")], "rid long, text string"), "text", 50, (20, 40))
