import itertools
import re

import numpy as np

from tidelog.llm import op4_decontaminate as op

TOKEN = re.compile(r"[^\W_]+")


def test_masks_hit_every_window_with_two_substitutions():
    places = [{s + o for o in m} for m in op.MASKS for s in range(op.WINDOW - m[-1])]
    for errors in itertools.combinations(range(op.WINDOW), 2):
        assert any(not p & set(errors) for p in places), errors


def brute(docs, items, window, percent):
    out = set()
    for (d, t), (i, u) in itertools.product(docs, items):
        a, b = TOKEN.findall((t or "").lower()), TOKEN.findall((u or "").lower())
        k = min(window, len(b))
        if not k:
            continue
        for g in range(-len(b), len(a)):
            same = [a[g + q] == b[q] for q in range(len(b)) if 0 <= g + q < len(a)]
            if len(same) >= k and any(100 * sum(same[x:x + k]) >= percent * k for x in range(len(same) - k + 1)):
                out.add((d, i))
    return out


def corpus():
    rng = np.random.default_rng(5)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 900, n)]

    items = [(i, " ".join(prose(n))) for i, n in enumerate([40, 30, 20, 13, 13, 25])] + [(None, " ".join(prose(22))), (7, None), (8, ""), (9, "a b c")]
    docs = []
    for k, (_, t) in enumerate(items[:7]):
        w = t.split()
        docs.append(prose(30) + w + prose(10))
        docs.append(prose(5) + [x.upper() + "," for x in w] + prose(3))
        for errors in (1, 2, 4, 8):
            v = list(w)
            for p in rng.choice(len(v), errors, replace=False):
                v[p] = f"x{p}"
            docs.append(prose(12) + v)
        docs.append(prose(9) + w[:13] + prose(9))
        docs.append(prose(9) + w[:11] + prose(9))
    docs += [prose(200), prose(12), [], ["the"] * 300, items[0][1].split() * 3]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    return rows + [(None, items[1][1]), (500, None), (0, rows[0][1])], items + [items[2]]


def test_equals_brute_force_up_to_two_substitutions(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, rid int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = op.overlaps(df, bench)
    rows = got.collect()
    want = brute(docs, items, op.WINDOW, op.PERCENT)
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    bad = {d for d, _ in want}
    kept = op.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_short_masks_hit_every_whole_item():
    for n in range(1, op.WINDOW):
        places = [{at + o for o in mask} for at, mask in op.short_masks(n)]
        allowed = max(e for e in range(n) if 100 * (n - e) >= op.PERCENT * n)
        for errors in itertools.combinations(range(n), allowed):
            assert any(p and max(p) < n and not p & set(errors) for p in places), (n, errors)


def test_short_items_are_found_with_all_substitutions_allowed(spark):
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, op.WINDOW)] + [(90, None), (91, "...")]
    docs = []
    for n, t in items[:-2]:
        for count in range(4):
            for errors in itertools.combinations(range(n), count):
                docs.append("before " * (n % 3) + " ".join("other" if k in errors else w for k, w in enumerate(t.split())) + " after")
    rows = list(enumerate(docs))
    got = op.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(rows, items, op.WINDOW, op.PERCENT)


def test_a_benchmark_over_the_bound_is_joined_by_shuffle(spark, monkeypatch):
    docs, items = corpus()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    small = {tuple(r) for r in op.overlaps(df, bench).collect()}
    monkeypatch.setattr(op, "BROADCAST_ROWS", 3)
    assert {tuple(r) for r in op.overlaps(df, bench).collect()} == small


def test_only_dataframe_functions(spark):
    docs, items = corpus()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = op.overlaps(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_tables(spark):
    df, bench = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string"), spark.createDataFrame([(1, "a " * 30)], "item_id long, text string")
    assert op.overlaps(df.limit(0), bench).collect() == [] and op.overlaps(df, bench.limit(0)).collect() == []
    assert op.decontaminate(df, bench.limit(0)).count() == 1 and op.decontaminate(df, bench).count() == 0
