"""Divergences against a dense brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tests.llm import data
from tidewell.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    """rows: (text, lang, source)."""
    in_docs, count = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        in_docs[lang].update(set(found))
        count[lang, source].update(found)
    out = []
    for lang in in_docs | {k[0]: 0 for k in count}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        groups = sorted(s for k, s in count if k == lang)
        whole = sum((count[lang, s] for s in groups), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // n for t in kept}

        p = {s: shares(count[lang, s]) for s in groups}
        q = shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            more = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", more, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:most])]
    return sorted(out)


def some_rows(rng):
    words = [data.words(rng, 1) for _ in range(60)] + ["Éte", "été", "ÀB", "straße", "日本", "a", "A"]
    rows = []
    for i in range(260):
        source = rng.choice(["a", "a", "a", "b", "c", "é", None])
        pool = words if source != "b" else words[:20]
        text = "".join(rng.choice(pool) + rng.choice([" ", "-", "1", "\n", "[", "\x7f"]) for _ in range(rng.choice([0, 1, 5, 40])))
        rows.append((text, rng.choice(["en", "en", "fr", None]), source))
    return rows + [(None, "en", "only"), ("zz", "xx", "one"), ("zz", "yy", "b"), ("", "yy", "a")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], data.DOC)


@pytest.mark.parametrize(("min_docs", "top", "held"), [(10, 10, 200_000), (3, 2, 5), (1, 10, 200_000), (10_000, 10, 200_000)])
def test_audit_against_brute_force(spark, monkeypatch, min_docs, top, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = some_rows(random.Random(min_docs))
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows), min_docs, top).collect())
    assert got == brute(rows, min_docs, top)


def test_shares_of_huge_counts_are_exact(spark):
    cases = [(0, 0, 1), (5, 9, 3), (9 * 10**12, 9 * 10**13, 10**6), (123456789012345 // 2, 9 * 10**13, 7), (10**11, 10**11, 0)]
    df = spark.createDataFrame(cases, "c long, n long, v long").select("*", divergence.share(*map(divergence.F.col, "cnv")).alias("p"))
    assert all(r.p == 1 + 10**9 * (r.c + 2) // (r.n + 2 * r.v) for r in df.collect())


def test_odd_and_empty_tables(spark):
    rows = [(r[1], r[2], r[3]) for r in data.odd_rows()]
    got = sorted(tuple(r) for r in divergence.audit(data.odd(spark)).collect())
    assert got == brute(rows, 10, 10)
    assert divergence.audit(data.empty(spark)).count() == 0


def test_the_query_against_sql(spark, tmp_path):
    frame(spark, some_rows(random.Random(8))).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(queries.ORACLES["op12_divergence"]).fetchall())
    assert sorted(tuple(r) for r in queries.op12_divergence(spark, str(tmp_path)).collect()) == want
