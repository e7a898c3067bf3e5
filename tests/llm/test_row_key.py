"""Rows whose ids and texts are strings or null keep apart."""

from pyspark.sql import functions as F

from tidelog.llm import op1_jaccard, op9_substring, op10_suffix
from tidelog.llm.base import row_key

ROWS = [("abc", None), (None, "abc"), ("", "abc"), ("abc", ""), (None, None), (None, " ".join(f"w{i}" for i in range(80))), (" ".join(f"w{i}" for i in range(80)), None)]
KIND = "doc_id string, text string"


def test_keys_are_null_safe(spark):
    df = spark.createDataFrame(ROWS, KIND)
    assert df.select(row_key("doc_id", "text").alias("k")).distinct().count() == len(ROWS)
    assert df.unionByName(df).select(row_key("doc_id", "text").alias("k")).distinct().count() == len(ROWS)


def test_jaccard_join_with_string_ids(spark):
    got = op1_jaccard.join(spark.createDataFrame(ROWS, KIND), 4, 85).collect()
    assert sorted((r.doc_id is None, r.doc_id or "", r.n_shingles, r.component_id) for r in got if r.n_shingles) == [
        (False, "", 1, ""), (True, "", 1, ""), (True, "", 77, None)]
    assert len(got) == len(ROWS)
    kept = op1_jaccard.representatives(spark.createDataFrame(ROWS, KIND)).collect()
    assert sorted((r.doc_id is None, r.doc_id or "", r.text is None) for r in kept) == sorted(
        (d is None, d or "", t is None) for d, t in ROWS if (d, t) != (None, "abc"))


def test_dedup_with_string_ids(spark):
    df = spark.createDataFrame(ROWS, KIND)
    words = {(r.doc_id, r.text): (r.n_words, r.n_removed) for r in op9_substring.deduplicate(df, 3, 1).collect()}
    assert words == {(d, t): (len((t or "").split()), 0) for d, t in ROWS}
    octets = {(r.doc_id, r.text): (r.n_bytes, r.n_removed) for r in op10_suffix.deduplicate(df).collect()}
    assert octets == {(d, t): (len(t or ""), 0) for d, t in ROWS}
