"""op13_divergence against plain loops and its SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from muster.llm.op13_divergence import audit, kept_terms, oracle, share

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LONG = "eins zwei Drei's vier5fünf " * 60_000
ODD = [
    ("Alpha beta BETA ß", "en", "a"), ("alpha", "en", "b"), ("beta gamma", "en", "b"), (None, "en", "c"), ("", None, None), ("alpha beta", None, "x"), ("alpha", "", "x"), ("solo", "fr", "only"),
    ("12 34 _-", "de", "p"), ("éa ÉA éa", "de", "q"), (LONG, "de", "p"), (LONG, "de", "p"), ("ALPHA beta BETA ß", "en", "a"), ("tie tie", "tt", "s1"), ("tie tie", "tt", "s2"), ("tie tie", "tt", "s3"),
]


def plain(rows, least, smooth=5, most=50):
    docs, counts, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        docs.update({(lang, t) for t in terms})
        counts[lang, source].update(terms)
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept, sources = [t for (x, t), n in docs.items() if x == lang and n >= least], sorted(s for x, s in groups if x == lang)

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + smooth) // (n + smooth * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, most)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def rows_of(frame):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in frame.collect())


@pytest.mark.parametrize("least", [1, 2, 3, 99])
def test_odd_rows_equal_plain_loops(spark, least):
    frame = spark.createDataFrame(ODD, "text string, lang string, source string").selectExpr("*", "1 as term", "2 as n", "3 as value", "'z' as names")
    assert rows_of(audit(frame, least)) == plain(ODD, least)


def test_runs_over_many_batches_equal_plain_loops(spark, monkeypatch):
    """Records of one term in many batches of few rows."""
    rng = np.random.default_rng(3)
    rows = [(" ".join(f"t{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in rng.integers(0, 90, 12)), f"l{i % 2}", f"s{int(rng.integers(0, 7))}") for i in range(600)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rows_of(audit(frame, 30, most_terms=5))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain(rows, 30, most=5)


def test_empty_table(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert audit(none).count() == 0 and kept_terms(none).count() == 0


def test_shares_are_exact_in_64_bits():
    for count, total, terms in ((0, 0, 1), (8 * 10**15, 9 * 10**15, 10**6), (123456789012, 98765432109876, 77)):
        assert share(np.array([count]), np.array([total]), terms)[0] == 1 + 10**9 * (count + 5) // (total + 5 * terms)


def test_query_equals_sql(spark):
    from muster.llm.queries import QUERIES

    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert rows_of(QUERIES["op13_divergence"](spark, SF)) == sorted(c.execute(f"select lang, source, part, item, value, rank from ({oracle()})").fetchall())
