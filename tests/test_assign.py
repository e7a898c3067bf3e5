"""Sticky least-loaded assignment against a heap, plus the assigner scenarios."""

import heapq

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import assign as asg


def _heap(existing, new_keys, n):
    """Brute force: pop the least-loaded task (ties to the lowest id) for each new key."""
    counts = [0] * n
    for _, t in existing:
        if t is not None and t < n:
            counts[t] += 1
    h = [(c, t) for t, c in enumerate(counts)]
    heapq.heapify(h)
    out = {}
    for k in new_keys:
        c, t = heapq.heappop(h)
        out[k] = t
        heapq.heappush(h, (c + 1, t))
    return out


def _keys(spark, ks):
    return spark.createDataFrame([(k,) for k in ks], "key BIGINT")


def _existing(spark, items):
    return spark.createDataFrame(items, "key BIGINT, task INT")


def _run(spark, keys, n, existing=None, registered=None):
    out = asg.assign_least_loaded(_keys(spark, keys), ["key"], n,
                                  existing=_existing(spark, existing) if existing is not None else None,
                                  registered=registered)
    return {r["key"]: r["task"] for r in out.collect()}


def test_two_keys_two_tasks_then_nothing_new(spark):
    first = _run(spark, [0, 1], 2)
    assert first == {0: 0, 1: 1}
    again = _run(spark, [0, 1], 2, existing=list(first.items()))
    assert again == first


def test_late_registered_task(spark):
    got = _run(spark, [0, 1], 2, registered=[0])
    assert got == {0: 0, 1: None}
    # the second task registers: the left-over key goes to it, key 0 stays
    assert _run(spark, [0, 1], 2, existing=list(got.items())) == {0: 0, 1: 1}


def test_distribution_100_then_200_more(spark):
    first = _run(spark, range(100), 2)
    assert sorted(list(first.values()).count(t) for t in (0, 1)) == [50, 50]
    second = _run(spark, range(300), 3, existing=list(first.items()))
    assert all(second[k] == first[k] for k in range(100))
    added = [second[k] for k in range(100, 300)]
    assert [added.count(t) for t in (0, 1, 2)] == [50, 50, 100]


def test_parallelism_must_be_positive(spark):
    with pytest.raises(ValueError, match="at least one"):
        _run(spark, [1], 0)


@settings(max_examples=10, deadline=None)
@given(st.integers(1, 7), st.lists(st.integers(0, 9), max_size=25), st.integers(0, 40), st.randoms(use_true_random=False))
def test_closed_form_equals_heap(spark, n, held_tasks, m, rnd):
    existing = [(1000 + i, t) for i, t in enumerate(held_tasks)]         # some tasks >= n: kept, not counted
    new = rnd.sample(range(500), m)
    got = _run(spark, [k for k, _ in existing] + new, n, existing=existing)
    want = _heap(existing, sorted(new), n)
    assert {k: got[k] for k in new} == want
    assert all(got[k] == t for k, t in existing)


def test_upsert_latest_split_wins_and_clears_task(spark):
    ev = spark.createDataFrame([(1, 5, 0, 0), (1, 6, None, 1), (2, 3, 1, 0)],
                               "part INT, start_off BIGINT, task INT, seq INT")
    assert rows(asg.upsert_splits(ev)) == [(1, 6, None), (2, 3, 1)]


def test_listing_after_two_rounds_keeps_everything(spark):
    first = asg.assign_least_loaded(_keys(spark, [0, 1, 2]), ["key"], 2)
    second = asg.assign_least_loaded(_keys(spark, [0, 1, 2, 3, 4]), ["key"], 2, existing=first)
    assert sorted(r["key"] for r in second.collect()) == [0, 1, 2, 3, 4]


def test_returned_keys_reenter_the_pool(spark):
    first = asg.assign_least_loaded(_keys(spark, range(6)), ["key"], 3)
    back = asg.return_tasks(first, [1])
    assert back.where(F.col("task").isNull()).count() == 2
    again = asg.assign_least_loaded(back.select("key"), ["key"], 3, existing=back)
    assert rows(asg.task_load(again)) == [(0, 2), (1, 2), (2, 2)]


def test_every_registered_task_is_listed(spark):
    a = _existing(spark, [(1, 0), (2, 0)])
    assert rows(asg.tasks_view(a, [0, 3])) == [(0, 2), (3, 0)]


@settings(max_examples=6, deadline=None)
@given(st.integers(2, 6), st.lists(st.integers(0, 5), min_size=3, max_size=30), st.integers(1, 40),
       st.randoms(use_true_random=False))
def test_closed_form_with_uneven_tasks(spark, n, held_tasks, m, rnd):
    existing = [(1000 + i, t) for i, t in enumerate(held_tasks)]
    new = rnd.sample(range(500), m)
    got = _run(spark, [k for k, _ in existing] + new, n, existing=existing)
    assert {k: got[k] for k in new} == _heap(existing, sorted(new), n)


def test_water_level_bounds_the_slots(spark, monkeypatch):
    import time

    from tidelog.operators import assign as op

    listed = []
    real = op.leveling_slots
    monkeypatch.setattr(op, "leveling_slots", lambda counts, top: listed.append(counts.where(F.col("c") < top).selectExpr(
        f"sum({top} - c)").first()[0] or 0) or real(counts, top))
    held = spark.range(300_000).selectExpr("id AS key", "CAST(7 AS INT) AS task")
    start = time.time()
    for new in (1, 60):
        keys = held.select("key").unionByName(spark.range(300_000, 300_000 + new).selectExpr("id AS key"))
        got = op.assign_least_loaded(keys, ["key"], 50, held)
        added = sorted((r.key, r.task) for r in got.where("key >= 300000").collect())
        others = [t for t in range(50) if t != 7]
        assert added == [(300_000 + i, others[i % 49]) for i in range(new)]
        assert listed[-1] <= new + 50
    assert time.time() - start < 60


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=6), st.integers(0, 40))
def test_uneven_counts_equal_the_heap(spark, counts, new):
    import heapq

    from tidelog.operators import assign as op

    held = [(f"h{t}-{i}", t) for t, c in enumerate(counts) for i in range(c)]
    heap = [(c, t) for t, c in enumerate(counts)]
    heapq.heapify(heap)
    want = {}
    for i in range(new):
        c, t = heapq.heappop(heap)
        want[f"n{i:03d}"] = t
        heapq.heappush(heap, (c + 1, t))
    existing = spark.createDataFrame(held, "key STRING, task INT")
    keys = spark.createDataFrame([(f"n{i:03d}",) for i in range(new)] + [(k,) for k, _ in held], "key STRING")
    got = {r.key: r.task for r in op.assign_least_loaded(keys, ["key"], len(counts), existing).collect()}
    assert got == {**dict(held), **want}
