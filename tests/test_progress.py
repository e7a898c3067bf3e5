"""Checkpoint commit rule, committed cursors, redelivery and the skew-safe ordered helpers."""
import pytest

import random

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import progress as pg
from tidelog.operators.ordered import index_within, prefix_max, prev_offset


def _trace(spark, adds, notes):
    """adds: [(ck, added_at)] in insertion order; notes: [(ck, notified_at)]; one reader."""
    cks = spark.createDataFrame([(0, ck, t, i) for i, (ck, t) in enumerate(adds)],
                                "reader INT, ck BIGINT, added_at BIGINT, seq BIGINT")
    ns = spark.createDataFrame([(0, ck, t) for ck, t in notes], "reader INT, ck BIGINT, notified_at BIGINT")
    return cks, ns


def _fold(adds, notes):
    """Brute force: replay adds and completions in time order (adds first at equal times)."""
    events = [(t, 0, i, ck) for i, (ck, t) in enumerate(adds)] + [(t, 1, ck, ck) for ck, t in notes]
    pending, out = [], {}
    for t, kind, order, ck in sorted(events):
        if kind == 0:
            pending.append(ck)
        elif ck in pending:
            out[(ck, t)] = True
            del pending[:pending.index(ck) + 1]
        else:
            out[(ck, t)] = False
    return out


def test_complete_prunes_older_insertions(spark):
    # add 2 then add 1; complete 1 commits it and prunes 2; complete 2 then does nothing
    cks, ns = _trace(spark, [(2, 0), (1, 1)], [(1, 2), (2, 3)])
    assert rows(pg.effective_commits(cks, ns), "ck", "effective") == [(1, True), (2, False)]


def test_unknown_checkpoint_is_a_no_op(spark):
    cks, ns = _trace(spark, [(1, 0)], [(4, 1), (1, 2)])
    assert rows(pg.effective_commits(cks, ns), "ck", "effective") == [(1, True), (4, False)]


def test_completion_before_add_is_unknown(spark):
    cks, ns = _trace(spark, [(1, 5)], [(1, 3)])
    assert rows(pg.effective_commits(cks, ns), "ck", "effective") == [(1, False)]


@settings(max_examples=12, deadline=None)
@given(st.integers(1, 12), st.randoms(use_true_random=False))
def test_window_rule_equals_fold(spark, n, rnd):
    times = sorted(rnd.randint(0, 20) for _ in range(n))
    adds = list(zip(rnd.sample(range(100), n), times))
    notes = [(ck, rnd.randint(0, 25)) for ck, _ in adds if rnd.random() < 0.8] + [(999, rnd.randint(0, 25))]
    # some checkpoints are reported complete twice, at different times (the second is a no-op)
    notes += [(ck, t + rnd.randint(1, 5)) for ck, t in notes if rnd.random() < 0.3]
    notes = list({(ck, t): (ck, t) for ck, t in notes}.values())
    cks, ns = _trace(spark, adds, notes)
    got = {(r["ck"], r["notified_at"]): r["effective"]
           for r in pg.effective_commits(cks, ns, chunk_width=3).collect()}
    assert got == _fold(adds, notes)


def test_committed_cursors_take_last_effective(spark):
    snaps = spark.createDataFrame([(0, 1, 0, 5), (0, 1, 2, 7), (0, 2, 0, 9), (0, 2, 2, 8), (1, 1, 1, 3)],
                                  "reader INT, ck BIGINT, part INT, position BIGINT")
    commits = spark.createDataFrame([(0, 1, 3, True), (0, 2, 4, True), (1, 1, 2, False)],
                                    "reader INT, ck BIGINT, notified_at BIGINT, effective BOOLEAN")
    assert rows(pg.committed_cursors(snaps, commits)) == [(0, 9), (2, 8)]


def test_checkpoint_snapshots_carry_positions_forward(spark):
    log = spark.createDataFrame([(0, 1, 0), (0, 4, 2), (1, 3, 1), (2, 5, 2)], "part INT, off BIGINT, day INT")
    snaps = pg.checkpoint_snapshots(log, F.col("day"), readers=2, chunk_width=2)
    assert rows(snaps, "ck", "part", "position") == [
        (0, 0, 1), (0, 1, 0), (0, 2, 0),
        (1, 0, 1), (1, 1, 3), (1, 2, 0),
        (2, 0, 4), (2, 1, 3), (2, 2, 5)]
    assert {(r["part"], r["reader"]) for r in snaps.collect()} == {(0, 0), (1, 1), (2, 0)}


def test_redelivery_inclusive_and_exclusive(spark):
    consumed = spark.createDataFrame([(0, o) for o in range(5)] + [(1, 10)], "part INT, off BIGINT")
    committed = spark.createDataFrame([(0, 3)], "part INT, position BIGINT")
    assert rows(pg.redelivered(consumed, committed)) == [(0, 3), (0, 4), (1, 10)]
    assert rows(pg.redelivered(consumed, committed, inclusive=False)) == [(0, 4), (1, 10)]
    log = consumed.unionByName(spark.createDataFrame([(0, 5)], "part INT, off BIGINT"))
    again = pg.resume_scan(log, committed)
    assert rows(pg.dedup_redelivered(consumed, again)) == rows(log)


def _hot_rows(seed, n=300):
    rnd = random.Random(seed)
    out, offs = [], {}
    for _ in range(n):
        p = 0 if rnd.random() < 0.6 else rnd.randint(1, 4)     # partition 0 is hot
        offs[p] = offs.get(p, -1) + rnd.randint(1, 3)          # sparse, increasing
        out.append((p, offs[p], rnd.randint(0, 50)))
    return out


def test_prev_offset_matches_lag_on_hot_partition(spark):
    data = _hot_rows(1)
    df = spark.createDataFrame(data, "part INT, off BIGINT, v INT")
    got = {(r["part"], r["off"]): r["prev_off"] for r in prev_offset(df, width=4).collect()}
    want, last = {}, {}
    for p, o, _ in sorted(data):
        want[(p, o)] = last.get(p)
        last[p] = o
    assert got == want


def test_prefix_max_matches_running_max(spark):
    data = _hot_rows(2)
    df = spark.createDataFrame(data, "part INT, off BIGINT, v INT")
    got = {(r["part"], r["off"]): r["m"] for r in
           prefix_max(df, ["part"], ["off"], "v", F.expr("off div 5"), "m").collect()}
    want, run = {}, {}
    for p, o, v in sorted(data):
        run[p] = max(run.get(p, v), v)
        want[(p, o)] = run[p]
    assert got == want


def test_index_within_numbers_every_group_densely(spark):
    data = _hot_rows(3)
    df = spark.createDataFrame(data, "part INT, off BIGINT, v INT")
    out = index_within(df, ["part"], ["v", "off"], out="i", num_ranges=5).collect()
    by = {}
    for r in out:
        by.setdefault(r["part"], []).append((r["v"], r["off"], r["i"]))
    for p, xs in by.items():
        xs.sort()
        assert [i for _, _, i in xs] == list(range(len(xs))), p


def test_index_within_global_rank(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 AS k")
    out = index_within(df, [], ["k"], out="r", num_ranges=7)
    assert out.where("r <> k").count() == 0


def test_dedup_by_position_equals_distinct(spark):
    rnd = random.Random(7)
    first, second = [], []
    for p in range(4):
        offs = sorted(rnd.sample(range(200), 60))
        stop = rnd.randint(10, 50)
        first += [(p, o) for o in offs[:stop]]
        cursor = offs[rnd.randint(0, stop - 1)]
        second += [(p, o) for o in offs if o >= cursor]
    second += [(9, 1), (9, 2)]                     # a partition the first run never read
    a = spark.createDataFrame(first, "part INT, off BIGINT")
    b = spark.createDataFrame(second, "part INT, off BIGINT")
    got = pg.dedup_by_position(a, b, part_bound=16)
    assert got.count() == len(set(first) | set(second))
    assert rows(got) == rows(pg.dedup_redelivered(a, b))


def test_incremental_tracker_equals_fold(spark):
    from tidelog.session import scratch_dir
    from tidelog.streaming.commits import commit_tracker

    rnd = random.Random(11)
    for trial in range(3):
        n = rnd.randint(3, 12)
        times = sorted(rnd.randint(0, 20) for _ in range(n))
        adds = list(zip(rnd.sample(range(100), n), times))
        notes = sorted({ck: (ck, rnd.randint(0, 25)) for ck, _ in adds if rnd.random() < 0.8}.values(),
                       key=lambda x: (x[1], x[0]))
        cks, _ = _trace(spark, adds, [])
        ck_path, out, state = (scratch_dir(spark, "t-cks"), scratch_dir(spark, "t-out"), scratch_dir(spark, "t-state"))
        cks.write.parquet(ck_path)
        write = commit_tracker(ck_path, out, state)
        cut1, cut2 = sorted(rnd.sample(range(len(notes) + 1), 2))
        for b, chunk in enumerate((notes[:cut1], notes[cut1:cut2], notes[cut2:])):
            df = spark.createDataFrame([(0, ck, t) for ck, t in chunk], "reader INT, ck BIGINT, notified_at BIGINT")
            write(df, b)
            if b == 1:
                write(df, b)                        # a replayed batch changes nothing
        got = {(r["ck"], r["notified_at"]): r["effective"] for r in spark.read.parquet(out).collect()}
        assert got == _fold(adds, notes), trial


def test_index_within_keeps_null_groups_and_null_orders(spark):
    data = [(None, 3), (None, 1), (1, None), (1, 2), (1, 1), (None, None)]
    df = spark.createDataFrame(data, "g INT, o INT")
    out = index_within(df, ["g"], ["o"], out="i", num_ranges=3).collect()
    assert len(out) == len(data)
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append(r["i"])
    assert {k: sorted(v) for k, v in by.items()} == {None: [0, 1, 2], 1: [0, 1, 2]}
    # nulls order first
    assert {(r["g"], r["o"]): r["i"] for r in out}[(None, None)] == 0


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 9), st.randoms(use_true_random=False))
def test_chunked_running_max_equals_brute_force(spark, width, rnd):
    data, offs = [], {}
    for _ in range(rnd.randint(1, 120)):
        p = 0 if rnd.random() < 0.5 else rnd.randint(1, 3)
        offs[p] = offs.get(p, rnd.randint(-5, 5)) + rnd.randint(1, 4)
        data.append((p, offs[p], rnd.choice([None, rnd.randint(-20, 20)])))
    df = spark.createDataFrame(data, "part INT, off BIGINT, v INT")
    got_prev = {(r["part"], r["off"]): r["prev_off"] for r in prev_offset(df, width=width).collect()}
    got_max = {(r["part"], r["off"]): r["m"] for r in prefix_max(
        df, ["part"], ["off"], "v", F.floor(F.col("off") / width), "m", inclusive=False).collect()}
    last, run, want_prev, want_max = {}, {}, {}, {}
    for p, o, v in sorted(data):
        want_prev[(p, o)] = last.get(p)
        want_max[(p, o)] = run.get(p)
        last[p] = o
        if v is not None:
            run[p] = v if run.get(p) is None else max(run[p], v)
    assert got_prev == want_prev
    assert got_max == want_max


def test_checkpoint_added_twice_is_accepted_but_not_by_the_incremental_tracker(spark):
    cks = spark.createDataFrame([(0, 1, 1, 1), (0, 1, 2, 2)], "reader INT, ck INT, added_at INT, seq INT")
    notes = spark.createDataFrame([(0, 1, 5)], "reader INT, ck INT, notified_at INT")
    assert rows(pg.effective_commits(cks, notes), "ck", "effective", "added_at") == [(1, True, 2)]
    prior = spark.createDataFrame([], "reader INT, max_seq INT")
    with pytest.raises(Exception, match="checkpoint added twice"):
        pg.effective_commits(cks, notes, prior=prior).collect()


def test_sparse_offsets_give_as_many_chunks_as_dense_ones(spark, monkeypatch):
    from tidelog.operators import ordered

    seen = []
    real = ordered.prefix_max
    monkeypatch.setattr(ordered, "prefix_max", lambda df, keys, order, value, chunk, *a, **k: seen.append(
        df.select("part", chunk.alias("c")).distinct().count()) or real(df, keys, order, value, chunk, *a, **k))
    for stride in (1, 2000):
        log = spark.range(6000).selectExpr("CAST(IF(id < 4000, 0, 1) AS INT) AS part", f"id * {stride} AS off")
        got = prev_offset(log, width=100)
        assert got.where("prev_off IS NOT NULL").selectExpr("min(off - prev_off)", "max(off - prev_off)", "count(*)").first() == (stride, stride, 5998)
    assert seen == [60, 60]
