"""A corpus pipeline of the training-data operators: STAGES in order, each over all rows its predecessor
kept.  A stage is ``fn(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of
``docs``.  Null and empty texts, null ids, repeated rows and empty tables have the results that the
operators' modules define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import op1_jaccard, op2_quality, op4_decontaminate, op8_sentencepiece, op9_substring
from tidelog.session import scratch_dir

#: No SQL: unigram Viterbi is not expressible.  tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the current policy of the quality rules."""
    return op2_quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: the least doc_id (five words, similarity 0.8)."""
    return op1_jaccard.representatives(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeats of 35 words and more.  A text that loses words is the words left,
    joined by one space, and ``n_chars`` follows it; a text without repeats stays as it is."""
    done = op9_substring.deduplicate(docs)
    added = done.columns[len(docs.columns):]
    plain = done.toDF(*docs.columns, *(f"__{c}" for c in added))
    cut = F.col("__n_removed") > 0
    return plain.withColumns({"text": F.when(cut, F.col("__kept")).otherwise(F.col("text")),
                              "n_chars": F.when(cut, F.length("__kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))}
                             ).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text overlaps no benchmark item."""
    return op4_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text: number, byte pieces, digest of the ids, log score and round trip."""
    return op8_sentencepiece.summary(docs)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", substrings),
          ("benchmark decontamination", benchmark), ("SentencePiece encoding and decoding", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_dir(spark, f"stage{i + 1}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
