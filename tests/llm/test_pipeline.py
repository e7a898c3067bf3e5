"""run() against plain Python over the smallest tables and a few hard rows."""

import re

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline as pipeline
from tidelog.llm import op8_sentencepiece
from tests.llm import test_op1, test_op2, test_op4, test_op9

SF = "/root/testdata/sf0.001"


def brute(rows, items):
    """(doc_id, text) of the rows that reach the last stage."""
    kept = []
    for d, t in rows:
        w, c, s, n, dup, rep = test_op2.brute(t)
        if not (w < 10 or 100 * rep > 20 * w or 100 * s > 5 * c or 100 * dup > 40 * n or c < 2 * w or c > 14 * w):
            kept.append((d, t))
    _, group = test_op1.brute(kept, 5, 80)
    best = {}
    for g, (d, t) in zip(group, kept):
        if g not in best or (d is None, d or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = (d, t)
    kept = list(best.values())
    cut = test_op9.brute([t for _, t in kept], 35)
    kept = [(d, left if gone else t) for (d, t), (_, gone, left) in zip(kept, cut)]
    bad = {d for d, _ in test_op4.brute(kept, items, 13, 80)}
    return [(d, t) for d, t in kept if d not in bad]


def test_run_equals_brute_force(spark, tmp_path):
    docs = pq.read_table(f"{SF}/documents.parquet")
    extra = [(90_001, None), (90_002, ""), (90_003, "too short"), (90_004, "ten words are enough to pass the rules here surely"),
             (90_004, "ten words are enough to pass the rules here surely"), (90_005, "#### " * 40)]
    more = pa.table({"doc_id": [i for i, _ in extra], "text": [t for _, t in extra], "lang": [None] * 6, "source": ["x"] * 6, "n_chars": [0] * 6}, docs.schema)
    pq.write_table(pa.concat_tables([docs, more]), tmp_path / "documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/benchmark.parquet"), tmp_path / "benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in pa.concat_tables([docs, more]).to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    codec = op8_sentencepiece.Codec(op8_sentencepiece.load(op8_sentencepiece.model_path()))
    want = sorted((d, len(codec.encode(t)), True) for d, t in brute(rows, items))
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.round_trip) for r in got) == want
    assert 50 < len(want) < len(rows)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert out.count() == 0
    assert len(pipeline.STAGES) == 5 and all(re.search(r"\w", n) for n, _ in pipeline.STAGES)
