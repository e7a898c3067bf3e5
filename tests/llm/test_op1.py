import re

import numpy as np
import pytest

from tidelog.llm import op1_jaccard as op
from tidelog.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [(rows[i][0], len(sets[i]), ids.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))], [find(i) for i in range(len(rows))]


def corpus():
    rng = np.random.default_rng(11)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 5000, n)]

    rows = []
    for n in (6, 9, 14, 30, 60, 150, 400, 900):
        base = prose(n)
        for k in range(14):
            w = list(base)
            for p in rng.integers(0, n, rng.integers(0, 1 + n // 14)):
                w[p] = f"x{rng.integers(0, 99)}"
            rows.append(" ".join(w) if k % 2 else " ".join(w).upper())
    shared = prose(25)
    rows += [" ".join(prose(30) + shared) for _ in range(40)]
    rows += ["", None, "   ", "one", "ONE", "one two", "two one", "a b c d", "A b c d e", "É é"] + ["same text here now"] * 20
    return [(i * 3 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words, percent, block", [(4, 85, 1 << 20), (5, 80, 700)])
def test_components_equal_brute_force(spark, words, percent, block, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ELEMENTS", block)
    monkeypatch.setattr(op, "BLOCK_SETS", 12 if block < 1000 else 3072)
    monkeypatch.setattr(op, "FEW", 3 if block < 1000 else 16)
    rows = corpus() + [(None, "null id alone"), (None, "same text here now"), (5, "row row twice"), (5, "row row twice")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, class string").repartition(6)
    want, groups = brute(rows, words, percent)
    got = op.join(df, words, percent).collect()
    order = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=order) == sorted(want, key=order)
    kept = op.representatives(df, words, percent)
    assert kept.columns == df.columns
    empty = sum(1 for _, n, _ in want if n == 0)
    with_words = len({g for g, (_, n, _) in zip(groups, want) if n})
    assert kept.count() == with_words + empty


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for percent in (80, 85, 95):
        bands = op.Bands(percent)
        for _ in range(300):
            n = int(rng.integers(1, 400))
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop, add = rng.integers(0, n // 6 + 1), rng.integers(0, n // 6 + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < percent * (len(a) + len(b) - both):
                continue
            owner, sig, need = op.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), bands)
            shared = set(sig[owner == 0]) & set(sig[owner == 1])
            assert len(shared) >= need[[x in shared for x in sig]].min(initial=10**6) if shared else False, (len(a), len(b), both)


def test_all_links_and_forest(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "rid long, text string")
    classes = op.sets_of(df, 4).persist()
    full = {(min(r), max(r)) for r in op.links(df, classes.where("n_shingles > 0"), 4, 85, forest=False).collect()}
    some = {(min(r), max(r)) for r in op.links(df, classes.where("n_shingles > 0"), 4, 85).collect()}
    assert some <= full and len(some) < len(full)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 6), (300, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.join(df).collect() == [] and op.representatives(df).collect() == []


def test_intersections_and_possible_pairs():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.permutation(base)[:rng.integers(1, len(base))], rng.integers(0, 1 << 63, rng.integers(0, 40)).astype(np.uint64)])) for _ in range(90)]
    sets += [base[:k] for k in (1, 1, 2, 3, 5, 8)]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    want = np.array([[len(np.intersect1d(a, b)) if i < j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert (op.intersections(np.concatenate(sets), owner, len(sets)) == want).all()
    assert (op.intersections(np.concatenate(sets), owner, len(sets), popular=5) == want).all()
    sizes, side = np.array([len(s) for s in sets]), np.zeros(len(sets))
    picked = [s[s % np.uint64(op.PICKED) == 0] for s in sets]
    i, j = op.linked_pairs(sets, sizes, side, 80)
    a, b = op.possible_pairs(picked, sizes, side, 80)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a, b):
        root[find(x)] = find(y)
    assert len(i) and all(find(x) == find(y) for x, y in zip(i, j))


def test_intersections_across_two_sides():
    rng = np.random.default_rng(5)
    for n, left, values in [(2, 1, 3), (40, 13, 30), (150, 149, 20), (150, 70, 2000), (5, 2, 1)]:
        sets = [np.unique(rng.integers(0, values, rng.integers(0, 60)).astype(np.uint64)) for _ in range(n)]
        owner = np.repeat(np.arange(n), [len(s) for s in sets])
        got = op.across(np.concatenate(sets), owner, left, n)
        assert np.array_equal(got, [[len(np.intersect1d(x, y)) for y in sets[left:]] for x in sets[:left]])
        every = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
        assert np.array_equal(op.intersections(np.concatenate(sets), owner, n), np.triu(every, 1))
        side = rng.permutation(np.arange(n) < left).astype(int)
        i, j = op._pairs(sets, side, lambda i, j, c: c >= 2)
        want = {(min(x, y), max(x, y)) for x in range(n) for y in range(n) if side[x] != side[y] and every[x][y] >= 2}
        assert {(min(x, y), max(x, y)) for x, y in zip(i.tolist(), j.tolist())} == want


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_wide_clusters_are_cut_before_their_blocks_are_paired(spark, words, percent, monkeypatch):
    """One cluster of all texts: what shares only a passage must not reach the pairs of blocks together."""
    rng = np.random.default_rng(7)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    shared = prose(60)
    rows = [(i, " ".join(prose(int(rng.integers(40, 90))) + shared)) for i in range(150)]
    # near copies of some, and texts that are little more than the passage
    rows += [(200 + i, rows[i][1] + f" x{i}") for i in range(0, 60, 3)] + [(300 + i, " ".join(shared + prose(i))) for i in range(5)]
    rows += [(r, t) for r, t in corpus() if t]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen, paired = [], op.blocked_pairs

    def recorded(members, *args):
        seen.append(members.groupBy("root").count().agg({"count": "max"}).first()[0])
        return paired(members, *args)

    def together(docs, words, percent, text="text"):
        return op.sets_of(docs, words, text).where("n_shingles > 0").select("class").distinct().selectExpr("class AS node", "0L AS root")

    monkeypatch.setattr(op, "candidate_clusters", together)
    monkeypatch.setattr(op, "blocked_pairs", recorded)
    monkeypatch.setattr(op, "BLOCK_SETS", 12)
    monkeypatch.setattr(op, "PACKED", 1000, raising=False)
    monkeypatch.setattr(op, "PART", 500, raising=False)
    monkeypatch.setattr(op, "COUNTED", 100, raising=False)
    got = op.join(df, words, percent).collect()
    want, _ = brute(rows, words, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)
    assert len(seen) == 2 and max(seen) < 30, seen


@pytest.mark.parametrize("power", [5, 20])
def test_shared_elements_are_counted_in_their_cluster(spark, power):
    texts = ["a b c d e", "a b c d x", "q r s t u", "b c d e f g h"]
    rows = [(i + 10, root, t) for root, some in ((1, texts), (-2, texts[:1])) for i, t in enumerate(some)]
    df = spark.createDataFrame([(k * root, root, t) for k, root, t in rows], "class long, root long, body string")
    got = {}
    for r in op.shared_elements(df, 2, power).collect():
        got.setdefault(r["class"], []).append(r["held"])
    # cluster 1: bc, cd in three sets, ab and de in two; cluster -2 has one set alone
    assert {k: sorted(v) for k, v in got.items()} == {10: [2, 2, 3, 3], 11: [2, 3, 3], 13: [2, 3, 3]}


def test_packed_elements_keep_class_and_part():
    rng = np.random.default_rng(1)
    sizes = np.array([5, 1, 400, 0, 60])
    prints, keys = rng.integers(0, 1 << 64, int(sizes.sum()), dtype=np.uint64), np.array([7, -3, 9, 4, 11])
    found = []
    for row in op.packed(prints, keys, sizes, 3).to_pylist():
        low = np.frombuffer(row["prints"], np.uint8).reshape(-1, 6)
        low = np.pad(low, ((0, 0), (0, 2))).view("<u8").ravel()
        owner = np.repeat(np.frombuffer(row["classes"], "<i8"), np.frombuffer(row["counts"], "<u4"))
        found += [(int(k), row["part"], int(x)) for k, x in zip(owner, low, strict=True)]
    want = [(int(k), int(x) >> 61, int(x) & (1 << 48) - 1) for k, x in zip(np.repeat(keys, sizes), prints)]
    assert sorted(found) == sorted(want)
