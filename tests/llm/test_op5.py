import pytest

from tidelog.llm import op5_tokens as op

TEXTS = ["", None, "Hello  world, it's  a test\n\n 123x", "<|endoftext|> and <|endoftext|", "naïve été ̈ 𝟙 ⅷ １２ \x85x​z",
         "word " * 5000, "Ünïcödé\tTabs\r\n  ", "\U0001F984\U0001FAE0 ͸\U0001E4D0", " ", "日本語テキスト と 한국어"]


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(op.tokenizer_path())
    rows = [(i, x, "clash") for i, x in enumerate(TEXTS)] + [(None, "no id", "clash"), (1, "a  b", "x"), (1, "a  b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in op.token_counts(df, table_size=500, cache_size=3).collect())
    want = sorted((i is None, i or 0, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x, _ in rows)
    assert got == want


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_on_whole_table(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(op.tokenizer_path())
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op.query(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(t.encode(d.text or "", add_special_tokens=False).ids)
        assert got[d.doc_id] == (len((d.text or "").encode()), n, n > 512)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.token_counts(df).collect() == []
