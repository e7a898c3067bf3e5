import math
import re
import zlib
from collections import Counter

import pytest

from tidelog.llm import op6_lm as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = "\n"


def toks(t):
    return WORD.findall((t or "").translate(LOWER)) + [END]


def out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


class Brute:
    def __init__(self, texts, order=3, arcs=op.ARCS, least=op.MIN_COUNT):
        docs = [toks(t) for t in texts]
        self.uni = Counter(w for d in docs for w in d)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        low = max(least, -(-self.n // arcs))
        self.kept = {(w,): c for w, c in self.uni.items() if c >= low}
        for k in range(2, order + 1):
            grams = Counter(tuple(d[i:i + k]) for d in docs for i in range(len(d) - k + 1))
            self.kept |= {g: c for g, c in grams.items() if c >= low}
        self.order = order

    def p(self, w, h):
        h = tuple(h)[-(self.order - 1):] if self.order > 1 else ()
        if not h:
            return (self.uni[w] + 0.1) / (self.n + 0.1 * (self.v + 1))
        if h not in self.kept:
            return self.p(w, h[1:])
        arcs = {g[-1]: c for g, c in self.kept.items() if len(g) == len(h) + 1 and g[:-1] == h}
        left = 1 - sum(c - op.DISCOUNT for c in arcs.values()) / self.kept[h]
        return (arcs[w] - op.DISCOUNT if w in arcs else 0) / self.kept[h] + left * self.p(w, h[1:])

    def score(self, t):
        d = toks(t)
        return sum(math.log10(self.p(w, d[max(0, i - 2):i])) for i, w in enumerate(d))


TEXTS = ["the cat sat on the mat", "The cat sat on a hat", "a dog sat on the cat", "the the the the", "", None, "the dog",
         "zebra cat sat on the mat and the cat sat", "A É é 日本", "on the mat on the mat on the mat"] * 3 + ["only once here"]


@pytest.mark.parametrize("order, least, arcs", [(3, 2, op.ARCS), (3, 1, op.ARCS), (2, 2, op.ARCS), (1, 2, op.ARCS), (3, 2, 30)])
def test_scores_equal_brute_force(spark, order, least, arcs):
    rows = [(i, t, "clash", 1.0) for i, t in enumerate(TEXTS)] + [(None, "the cat", "c", 2.0), (3, TEXTS[3], "c", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, score double").repartition(4)
    model, counts = op.train(df.where(~op.held_out()), arcs=arcs, order=order, min_count=least)
    got = op.score(df, model, counts, block_bytes=200).collect()
    b = Brute([t for i, t, *_ in rows if not out(i)], order, arcs, least)
    assert len(got) == len(rows) and {len(k) for k in model.keys} and len(model.keys) == order
    text = {i: t for i, t, *_ in rows}
    for r in got:
        t = text[r.doc_id]
        assert r.held_out == out(r.doc_id) and r.n_tokens == len(toks(t)) and r.train_tokens == b.n
        assert r.n_known == sum(b.uni[w] > 0 for w in toks(t))
        assert r.base_score == pytest.approx(sum(math.log10(b.p(w, ())) for w in toks(t)))
        assert r.score == pytest.approx(b.score(t) if order == 3 else sum(
            math.log10(b.p(w, toks(t)[max(0, i - order + 1):i])) for i, w in enumerate(toks(t))))


def test_distributions_sum_to_one():
    b = Brute([t for t in TEXTS])
    for h in [(), ("the",), ("on", "the"), ("cat", "sat"), ("nothing",), ("zebra", "the")]:
        assert sum(b.p(w, h) for w in b.uni) + b.p("never seen", h) == pytest.approx(1)


def test_held_out_texts_are_better_predicted_than_by_words_alone(spark):
    got = op.query(spark, "/root/testdata/sf0.01").where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "count(*) n").first()
    assert got.n > 50 and got.s > got.b


def test_no_training_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model, counts = op.train(df.limit(0))
    r = op.score(df, model, counts).collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens) for x in r] == [(3, 0, 0)]
    assert op.score(df.limit(0), model, counts).collect() == []


@pytest.mark.parametrize("cache", [1, op.ARCS])
def test_no_n_gram_is_lost_to_the_size_of_the_corpus(spark, monkeypatch, cache):
    monkeypatch.setattr(op, "ARCS", cache)
    monkeypatch.setattr(op, "PART_BYTES", 100)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    model, counts = op.train(df.where(~op.held_out()))
    b = Brute([t for i, t in enumerate(TEXTS) if not out(i)], arcs=1 << 60)
    got = op.score(df, model, counts, block_bytes=200).collect()
    assert len(got) == len(TEXTS) and counts.count() > 1
    assert all(r.score == pytest.approx(b.score(TEXTS[r.doc_id])) for r in got)


def test_a_pair_counts_as_much_in_a_large_corpus_as_in_a_small_one(spark):
    texts = ["so a rare pair is seen"] * 2 + ["f " * 1000] * 2500
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model, counts = op.train(df)
    assert model.total > 2 << 20
    got = op.score(df.where("doc_id < 2"), model, counts).first()
    assert got.score == pytest.approx(Brute(texts, arcs=1 << 60).score(texts[0]))
    assert got.score > got.base_score / 2


def test_counting_and_scoring_take_several_jobs(spark, monkeypatch):
    made, plain = [], op.written
    monkeypatch.setattr(op, "written", lambda df, name: made.append((name, plain(df, name))) or made[-1][1])
    df = spark.createDataFrame([(i, f"some words w{i % 3} and w{i % 5}") for i in range(40)], "doc_id long, text string")
    model, counts = op.train(df)
    assert op.score(df, model, counts, block_bytes=100).count() == 40
    grams = [{r.part for r in t.select("part").collect()} for name, t in made if name == "grams"]
    assert len(grams) == 2 and all(grams) and not grams[0] & grams[1]
    scores = [t.count() for name, t in made if name == "scores"]
    assert len(scores) == 4 and max(scores) < 40


def test_rows_to_merge_do_not_stay_beside_the_merged_ones():
    import numpy as np

    rows = [(np.array(k, np.uint64), np.ones(len(k), np.uint8), np.array(k, np.uint64) + np.uint64(1), np.arange(len(k))) for k in ([3, 1 << 63, 5], [5, 3])]
    keys, length, history, n = op.merged(rows)
    assert rows == [] and length.itemsize == 1
    assert keys.tolist() == [3, 5, 1 << 63] and history.tolist() == [4, 6, (1 << 63) + 1] and n.tolist() == [1, 2, 1]


@pytest.mark.parametrize("values", [[], [0, 0], [255, 0, 3], [256, 1], [1 << 40, 7, 0]])
def test_numbers_take_the_bytes_they_need(values):
    import numpy as np
    import pyarrow as pa

    packed = op.planes(np.array(values, dtype=np.int64))
    assert len(packed) == len(values) * ((max(values, default=0).bit_length() + 7) // 8)
    assert op.numbers_of(pa.scalar(packed, pa.binary()), len(values)).tolist() == values
    keys = np.array(values, dtype=np.uint64)
    assert len(op.planes(keys)) == 8 * len(values) and op.keys_of(pa.scalar(op.planes(keys), pa.binary())).tolist() == values
