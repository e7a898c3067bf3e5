"""Every registered query against its DuckDB SQL on the smallest test tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
import check_oracle as C  # noqa: E402
from tidelog.plans import registry  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in C.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["part", "emitted", "skipped", "position"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_listed():
    assert set(registry.oracle_sql()) == set(registry.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    res = duck.execute(registry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = [dcols.index(c) for c in df.columns]
    want = C._rows([tuple(r[i] for i in order) for r in res.fetchall()])
    got = C._rows([tuple(r) for r in df.collect()])
    assert got == want
