import itertools

import numpy as np
import pytest
import xxhash

from tidelog.llm import op12_simhash as op


def brute_print(text, words=3):
    held = (text or "").encode().lower().split()
    grams = [b" ".join(held[i:i + words]) for i in range(len(held) - words + 1)] or ([b" ".join(held)] if held else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids, radius):
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            up[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(prints))]


def corpus():
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 500, 150)]
        texts.append(" ".join(base))
        for _ in range(rng.integers(0, 6)):
            copy = list(base)
            copy[rng.integers(0, 150)] = "changed"
            texts.append(" ".join(copy).title())
    return texts + [texts[0]] * 3 + [None, "", " \t\n", "one", "two words", "Three Small words", "é ü x", "a " * 400, "z" * 5000]


def test_equals_brute_force(spark):
    texts = corpus()
    ids = [None if i == 4 else 7 * i % 101 for i in range(len(texts))]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in zip(ids, texts)], "doc_id long, text string, fp string, shard int").repartition(5)
    prints = [brute_print(t) for t in texts]
    want = brute_components(prints, ids, 3)
    assert len(set(want)) < len(set(prints)) < len(texts)
    got = op.deduplicate(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == sorted(
        (d is None, d or 0, f"{p:016x}", c) for d, p, c in zip(ids, prints, want))


def test_long_text_in_pieces():
    text = " ".join(f"W{i % 977}" for i in range(3000)).encode()
    whole = op.fingerprint(text)
    assert whole & (1 << 64) - 1 == brute_print(text.decode())
    assert {op.fingerprint(text, limit=n) for n in (1, 7, 100, 4096)} == {whole}
    assert op.fingerprint(b"a b" + b" " * 5000, limit=10) & (1 << 64) - 1 == brute_print("a b")


def near(rng, n, groups, spread):
    centre = rng.integers(0, 1 << 63, groups, dtype=np.uint64)
    out = centre[rng.integers(0, groups, n)]
    for _ in range(spread):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(out)


@pytest.mark.parametrize("n, groups, spread, radius", [(400, 3, 2, 3), (700, 40, 4, 3), (600, 1, 5, 3), (300, 5, 6, 7)])
def test_tree_search_gives_the_components_of_all_pairs(n, groups, spread, radius):
    fp = near(np.random.default_rng(n), n, groups, spread)
    close = op.distance(fp[:, None], fp[None, :]) <= radius
    want = op.Forest(len(fp))
    list(want.link(*np.nonzero(np.triu(close, 1))))
    got = op.Forest(len(fp))
    pairs = list(op.search(fp, radius, (np.arange(len(fp)), None), got, 16))
    assert all(close[a, b] for a, b in pairs) and len(pairs) < len(fp)
    every = np.arange(len(fp))
    assert (got.labels(every) == want.labels(every)).all()
    # across two parts
    left, right = every[::2], every[1::2]
    want, got = op.Forest(len(fp)), op.Forest(len(fp))
    i, j = np.nonzero(close[np.ix_(left, right)])
    list(want.link(left[i], right[j]))
    list(op.search(fp, radius, (left, right), got, 16))
    assert (got.labels(every) == want.labels(every)).all()


@pytest.mark.parametrize("radius, blocks, vantages, cap", [(3, 4, 8, 1 << 17), (3, 2, 3, 1 << 17), (7, 4, 3, 60), (3, 1, 2, 40), (3, 4, 2, 20)])
def test_links_with_boundary_shards_and_cut_shards(spark, radius, blocks, vantages, cap):
    fp = near(np.random.default_rng(cap), 500, 6, 4)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    place = {int(x): i for i, x in enumerate(fp.view(np.int64))}
    got, want, every = op.Forest(len(fp)), op.Forest(len(fp)), np.arange(len(fp))
    pairs = [(place[r.a], place[r.b]) for r in op.links(df, radius, blocks, vantages, cap).collect()]
    list(got.link(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
    close = op.distance(fp[:, None], fp[None, :]) <= radius
    assert all(close[a, b] for a, b in pairs)
    list(want.link(*np.nonzero(np.triu(close, 1))))
    assert (got.labels(every) == want.labels(every)).all()


def test_empty_table_and_string_ids(spark):
    assert op.deduplicate(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([("b", "x y z w"), ("a", "X y z w"), (None, None), ("c", "")], "doc_id string, text string")
    got = {(r.doc_id, r.component_id) for r in op.deduplicate(df).collect()}
    assert got == {("b", "a"), ("a", "a"), (None, "c"), ("c", "c")}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in docs]
    want = brute_components(prints, [r.doc_id for r in docs], 3)
    got = op.query(spark, sf).collect()
    assert sorted(tuple(r) for r in got) == sorted((r.doc_id, f"{p:016x}", c) for r, p, c in zip(docs, prints, want))
