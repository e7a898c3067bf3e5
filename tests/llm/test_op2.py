import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import op2_quality as op
from tidelog.llm.base import flat

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(hit))


texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é#\n\t\x0b|", max_size=60)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_measurements_match_brute_force(rows):
    import pyarrow as pa

    buf, off = flat(pa.array(rows, pa.string()))
    m = op.measure_texts(buf, off)
    assert [tuple(int(m[k][i]) for k in op.MEASURES) for i in range(len(rows))] == [brute(t) for t in rows]


ROWS = [(1, None), (2, ""), (3, "alpha beta gamma delta eps zeta eta theta iota kappa la"), (4, "x y z u v " * 40), (None, "no id here but ten words one two three four"),
        (3, "alpha beta gamma delta eps zeta eta theta iota kappa la"), (5, "### $$$ " * 30 + "words"), (6, "long " * 3 + "w" * 200_000)]


def test_ledger_policies_and_ablations(spark):
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in ROWS], "doc_id long, text string, fail_bits string, n_words int")
    book = op.ledger(df)
    got = sorted(str(tuple(r)[:7]) for r in book.collect())
    assert got == sorted(str((i, *brute(t))) for i, t in ROWS)
    kept = {(r.doc_id, r.text) for r in op.accepted(df).collect()}
    assert kept == {(3, ROWS[2][1]), (None, ROWS[4][1])}
    assert op.accepted(df).columns == df.columns
    rows = {r.rule: r for r in op.ablations(book, "v1").collect()}
    bits = [r.fail_bits & op.mask_of("v1") for r in book.collect()]
    for rule in op.POLICIES["v1"]:
        m = op.mask_of([rule])
        assert rows[rule].failed == sum(1 for b in bits if b & m)
        assert rows[rule].failed_alone == sum(1 for b in bits if b == m)
        assert rows[rule].kept_without == sum(1 for b in bits if b & ~m == 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.ledger(df).collect() == [] and op.accepted(df).collect() == []
    assert op.ablations(op.ledger(df)).collect() == []
