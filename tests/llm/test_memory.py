import numpy as np
import pyarrow as pa

from tidelog.llm import base, op1_jaccard, rolling


def test_a_worker_keeps_no_table_of_a_long_text():
    rolling.Prefix(np.arange(1 << 20, dtype=np.uint64))
    assert max(len(p) for p in rolling._powers.values()) > 1 << 16
    base.give_back()
    assert rolling._powers and all(len(p) <= 1 << 16 and p.base is None for p in rolling._powers.values())
    # and the powers it makes anew are the same
    a = rolling.Prefix(np.arange(200_000, dtype=np.uint64)).windows(3)
    base.give_back()
    assert (a == rolling.Prefix(np.arange(200_000, dtype=np.uint64)).windows(3)).all()


def test_a_task_drops_what_another_operator_kept():
    base.kept("one")["codec"] = base.kept("two")["codec"] = object()
    base.give_back("one")
    assert base.kept("one") and not base.kept("two")
    base.give_back()
    assert not base.kept("one")


def test_rows_to_combine_are_edges_once_each():
    sig = np.repeat(np.arange(2), 40)
    keys = np.concatenate([np.arange(40), np.arange(40)])
    got = op1_jaccard.combined(sig, keys, np.ones(80, np.int64))
    edges = got[2] == op1_jaccard.EDGE
    assert sorted(zip(got[0][edges].tolist(), got[1][edges].tolist())) == [(i, 0) for i in range(1, 40)]
    assert (got[2] == op1_jaccard.MANY).sum() == 2


def test_batches_of_large_rows_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    rows = spark.range(0, 40, 1, 1).selectExpr("cast(repeat('x', 1 << 20) as binary) as body")
    got = [r.n for r in base.written(rows.mapInArrow(sizes, "n bigint"), "sizes").collect()]
    assert sum(got) >= 40 << 20 and max(got) < 20 << 20
