"""Commit rule with checkpoint ids that come again, finished splits, barriers where there are any."""

import random

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import commits as cm
from tidelog.operators import progress as pg
from tidelog.session import scratch_dir
from tidelog.streaming.commits_state import run_commit_stream

CKS = "reader INT, ck BIGINT, added_at BIGINT, seq BIGINT"
NOTES = "reader INT, ck BIGINT, notified_at BIGINT, note BIGINT"


def _fold(adds, notes):
    """Brute force over lists: (reader, ck, at, seq) and (reader, ck, at, note)."""
    out = []
    for reader in {r for r, *_ in adds + notes}:
        events = [(t, 0, s, 0, ck) for r, ck, t, s in adds if r == reader] + [(t, 1, ck, n, ck) for r, ck, t, n in notes if r == reader]
        order, value = [], {}
        for t, kind, a, note, ck in sorted(events):
            if kind == 0:
                if ck not in order:
                    order.append(ck)
                value[ck] = (t, a)
            elif ck in order:
                out.append((reader, ck, t, note, True, *value[ck]))
                order = order[order.index(ck) + 1:]
            else:
                out.append((reader, ck, t, note, False, None, None))
    return sorted(out, key=str)


def _random_trace(rnd, readers, ids, n):
    adds = [(rnd.randrange(readers), rnd.randrange(ids), rnd.randint(0, 30), i) for i in range(n)]
    notes = [(rnd.randrange(readers), rnd.randrange(ids + 1), rnd.randint(0, 35), i) for i in range(n)]
    return adds, notes


@settings(max_examples=12, deadline=None)
@given(st.integers(1, 40), st.randoms(use_true_random=False))
def test_repeated_ids_equal_the_fold(spark, n, rnd):
    adds, notes = _random_trace(rnd, 3, 5, n)
    # one reader adds each id once: its closed form must agree with the fold too
    adds += [(9, ck, rnd.randint(0, 30), 100 + i) for i, ck in enumerate(rnd.sample(range(20), 8))]
    notes += [(9, rnd.randrange(20), rnd.randint(0, 35), 100 + i) for i in range(12)]
    got = pg.effective_commits(spark.createDataFrame(adds, CKS), spark.createDataFrame(notes, NOTES), chunk_width=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _fold(adds, notes)


def test_adding_a_held_id_replaces_its_value_in_place(spark):
    adds = [(0, 2, 0, 0), (0, 1, 1, 1), (0, 2, 2, 2)]
    notes = [(0, 2, 3, 0), (0, 1, 4, 1)]
    got = pg.effective_commits(spark.createDataFrame(adds, CKS), spark.createDataFrame(notes, NOTES))
    assert rows(got, "ck", "effective", "added_at") == [(1, True, 1), (2, True, 2)]


def test_thousands_of_readers_in_batch_and_stream(spark):
    rnd = random.Random(8)
    adds, notes = _random_trace(rnd, 3000, 6, 6000)
    want = _fold(adds, notes)
    cks, ns = spark.createDataFrame(adds, CKS), spark.createDataFrame(notes, NOTES)
    assert sorted((tuple(r) for r in pg.effective_commits(cks, ns).collect()), key=str) == want
    events = cm.trace_events(cks, ns).select("reader", "ck", "at", "kind", F.col("tie.a").alias("tie_a"), F.col("tie.b").alias("tie_b"))
    inbox, out, ck = (scratch_dir(spark, f"cs-{x}") for x in ("in", "out", "ck"))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for i, some in enumerate(("at < 9", "at BETWEEN 9 AND 20", "at > 20")):
        events.where(some).write.parquet(f"{inbox}/{i}")
        run_commit_stream(spark.readStream.schema(events.schema).parquet(f"{inbox}/*"), out, ck)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    assert sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=str) == want


LOG = "part INT, off BIGINT, t BIGINT"
BARS = "reader INT, ck BIGINT, seq BIGINT, added_at BIGINT"
PARTS = "reader INT, part INT, start_off BIGINT"


def test_snapshots_only_where_a_barrier_is(spark):
    ms = 1_700_000_000_000                     # epoch milliseconds, days apart
    log = spark.createDataFrame([(0, 1, ms), (0, 4, ms + 2 * 86_400_000), (1, 3, ms + 1)], LOG)
    bars = spark.createDataFrame([(0, 7, 0, ms), (1, 7, 1, ms), (0, 7, 2, ms + 90_000_000), (0, 8, 3, ms + 10 ** 12)], BARS)
    parts = spark.createDataFrame([(0, 0, 0), (1, 1, 2), (0, 2, 5)], PARTS)
    got = pg.snapshots_at(log, bars, parts, at="t")
    assert rows(got, "reader", "ck", "seq", "part", "position") == [
        (0, 7, 0, 0, 1), (0, 7, 0, 2, 5), (0, 7, 2, 0, 1), (0, 7, 2, 2, 5), (0, 8, 3, 0, 4), (0, 8, 3, 2, 5), (1, 7, 1, 1, 2)]


def test_finished_split_is_committed_by_a_later_checkpoint(spark):
    log = spark.createDataFrame([(0, 5, 1), (0, 9, 20), (1, 2, 3)], LOG)
    finished = spark.createDataFrame([(0, 5, 10)], "part INT, position BIGINT, finished_at BIGINT")
    bars = spark.createDataFrame([(0, 1, 0, 30)], BARS)
    parts = spark.createDataFrame([(0, 0, 0), (0, 1, 0)], PARTS)
    snaps = pg.snapshots_at(log, bars, parts, finished, at="t")
    assert rows(snaps, "part", "position") == [(0, 5), (1, 2)]          # once each, at the finish
    commits = pg.effective_commits(spark.createDataFrame([(0, 1, 30, 0)], CKS), spark.createDataFrame([(0, 1, 31, 0)], NOTES))
    assert rows(pg.committed_cursors(snaps, commits)) == [(0, 5), (1, 2)]
    # a finished split that never got a message
    none = spark.createDataFrame([], LOG)
    start = spark.createDataFrame([(4, 7, 0)], "part INT, position BIGINT, finished_at BIGINT")
    one = spark.createDataFrame([(0, 4, 0)], PARTS)
    assert rows(pg.snapshots_at(none, bars, one, start, at="t"), "part", "position") == [(4, 7)]


def test_committed_cursor_is_that_of_the_adding_which_was_committed(spark):
    log = spark.createDataFrame([(0, o, 10 * o) for o in range(10)], LOG)
    adds = spark.createDataFrame([(0, 1, 15, 0), (0, 1, 45, 1), (0, 1, 99, 2)], CKS)
    notes = spark.createDataFrame([(0, 1, 50, 0)], NOTES)
    commits = pg.effective_commits(adds, notes)
    bars = commits.where("effective").select("reader", "ck", "seq", "added_at")
    parts = spark.createDataFrame([(0, 0, 0)], PARTS)
    assert rows(pg.committed_cursors(pg.snapshots_at(log, bars, parts, at="t"), commits)) == [(0, 4)]
