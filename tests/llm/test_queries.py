"""Registered queries of the operators against their DuckDB SQL, and what is registered."""

import os

import pytest

import __spark_entry__ as E
import check_oracle as C
from tidelog import llm

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm.queries())
    assert numbers == list(range(1, 14)) and set(llm.queries()) | {"pipeline"} <= set(E.queries())
    assert set(llm.queries()) - set(llm.oracle_sql()) == {"op5_token_counts", "op6_lm_scoring", "op8_sentencepiece", "op12_simhash_dedup", "op13_periodic_runs"}


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in C.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    df = llm.queries()[name](spark, SF)
    res = con.execute(llm.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = C._rows([tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()])
    assert C._rows([tuple(r) for r in df.collect()]) == want
