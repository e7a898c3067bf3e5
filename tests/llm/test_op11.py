import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidelog.llm import op11_divergence as op

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, ranks=10):
    docs, count, groups = defaultdict(set), defaultdict(Counter), set()
    for i, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in TERM.findall((text or "").translate(LOWER)):
            docs[lang, t].add(i)
            count[lang, source][t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for (x, t), d in docs.items() if x == lang and len(d) >= least}
        sources = sorted((s for x, s in groups if x == lang), key=str.encode)
        whole = Counter()
        for s in sources:
            whole.update({t: n for t, n in count[lang, s].items() if t in kept})

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept))

        ps = {s: {t: p(count[lang, s], t) for t in kept} for s in sources}
        q = {t: p(whole, t) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(ps[s][t], q[t]), t) for t in kept if count[lang, s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        lang, source = ["en", "fr", None, "", "zz"][rng.integers(0, 5)], [f"s{rng.integers(0, 7)}", None, "é", "hot", "hot"][rng.integers(0, 5)]
        words = [f"{'ABCDefgh'[x % 8]}{'été' if x % 5 == 0 else 'x'}{'qrst'[x % 4]}" for x in rng.zipf(1.4, rng.integers(0, 60)) % 97]
        rows.append(("1 _".join(words) if lang != "zz" else " ".join(f"q{chr(97 + i % 26)}{chr(97 + i // 26)}" for _ in range(3)), lang, source))
    return rows + [(None, "en", "hot"), ("", "xx", "only"), ("12 34", "xx", None), ("B" * 9000 + " ÀÉ \x00b\x7fb", "en", "hot")] + [rows[0]] * 3


@pytest.mark.parametrize("least, side, shard_rows", [(3, 128, 1 << 17), (10, 2, 40), (1, 3, 5)])
def test_equals_brute_force(spark, least, side, shard_rows):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "text string, lang string, source string, term string, n int, total int").repartition(6)
    got = op.audit(df, least, side=side, shard_rows=shard_rows)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least)


def test_partial_counts_are_sent_on_when_a_task_holds_many(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.record_batch([pa.array(["en", "en", None]), pa.array(["a", "b", "a"]), pa.array(["x y x Z", "X", None])], names=["lang", "source", "text"])
    got = op.add_up([op.count_terms(batch), op.count_terms(batch)]).to_pylist()
    assert sorted((r["lang"], r["source"], r["term"], r["n"], r["docs"]) for r in got) == [
        ("en", "a", "x", 4, 2), ("en", "a", "y", 2, 2), ("en", "a", "z", 2, 2), ("en", "b", "x", 2, 2)]
    assert [b.num_rows for b in op.slices(batch, 2, 2)] == [1, 2]


def test_exact_division():
    count, total = np.array([10 ** 14, 7, 2 * 10 ** 14, 2]), np.array([2 * 10 ** 14 + 1, 9, 2 * 10 ** 14, 10 ** 14 + 3])
    assert op.scaled_array(count, total).tolist() == [1 + 10 ** 9 * int(c) // int(t) for c, t in zip(count, total)]


def test_empty_table(spark):
    assert op.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []
