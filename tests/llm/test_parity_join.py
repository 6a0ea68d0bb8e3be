"""The Jaccard join against brute force."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import data
from tidewell.llm import parity_join, queries
from tidewell.llm.common import materialize


def shingle_set(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, num=90, den=100):
    """doc position -> (set size, smallest doc_id of its class)."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def family(rng, n_words, members, changes):
    base = data.words(rng, n_words).split()
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            at = rng.randrange(len(w))
            match rng.randrange(3):
                case 0:
                    w[at] = data.words(rng, 1)
                case 1:
                    w.insert(at, data.words(rng, 1))
                case _:
                    if len(w) > 1:
                        del w[at]
        out.append(" ".join(w))
    return out


def rows_of(rng):
    texts = [None, "", " \t", "one", "One", "one two", "ONE two three", "x y z", "x y z w"]
    for n in (9, 10, 12, 14, 19, 22, 28, 33, 40, 47, 60, 100, 300):
        for _ in range(3):
            texts += family(rng, n, 6, 1 + n // 25)
    texts += family(rng, 120, 60, 5)
    # nested sets of growing size: the ends of a chain need not be similar
    chain = data.words(rng, 200).split()
    texts += [" ".join(chain[: 60 + 4 * i]) for i in range(30)]
    texts += [texts[-1]] * 4
    rng.shuffle(texts)
    return [(i if i % 17 else None, t) for i, t in enumerate(texts)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "similarity"), [(1, (90, 100)), (2, (90, 100)), (3, (8, 10))])
def test_classes_against_brute_force(spark, seed, similarity):
    rows = rows_of(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert result(parity_join.classes(docs, similarity)) == brute(rows, *similarity)


def test_large_keys_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "PART", 64)
    rng = random.Random(9)
    rows = list(enumerate(t for _ in range(3) for t in family(rng, 90, 150, 9)))
    assert result(parity_join.classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_every_similar_pair_shares_a_key():
    """Pairs as far apart as the similarity allows, at all sizes of the smaller bands and some larger ones."""
    bands, rng = parity_join.Bands(90, 100), np.random.default_rng(3)
    for small in [*range(1, 130), 400, 1000, 5000]:
        for large in {small, small + 1, small + small // 18, small * 10 // 9}:
            both = -(-9 * (small + large) // 19)
            if both > small:
                continue
            for _ in range(4):
                h = rng.integers(0, 2**64, small + large - both, dtype=np.uint64, endpoint=False)
                a, b = h[:small], h[small - both :]
                assert len(a) == small and len(b) == large
                met = set()
                for one, ask in ((bands.of(small), 0), (bands.of(large), bands.below(large))):
                    met.add(one)
                band = bands.of(small)
                assert bands.of(large) == band or bands.below(large) == band
                if not bands.words(band):
                    assert small == large == both
                    continue
                x, y = (parity_join.parity(s, bands.words(band)) for s in (a, b))
                assert np.bitwise_count(x ^ y).sum() <= small + large - 2 * both <= bands.apart(small, large) <= bands.most(band)
                assert np.bitwise_count(parity_join.folded(x) ^ parity_join.folded(y)).sum() <= bands.apart(small, large)
                assert set(parity_join.keys_of(x, band, bands.most(band)).tolist()) & set(parity_join.keys_of(y, band, bands.most(band)).tolist())


def test_odd_and_empty_tables(spark):
    rows = [(r[0], r[1]) for r in data.odd_rows()]
    assert result(parity_join.classes(data.odd(spark))) == brute(rows)
    assert parity_join.classes(data.empty(spark)).count() == 0


def test_candidates_leave_unrelated_sets_alone(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, data.words(rng, 60 + i % 40)) for i in range(400)], "doc_id long, text string")
    bands = parity_join.Bands(90, 100)
    rows = materialize(parity_join.sets(docs.select(F.xxhash64("text").alias("key"), "doc_id", "text"), bands, 3))
    assert parity_join.keys(rows, bands).count() > 400 * 10
    assert parity_join.star_pairs(parity_join.shared_keys(parity_join.keys(rows, bands))).count() < 40


def test_the_query_against_sql(spark, tmp_path):
    rows = rows_of(random.Random(21))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(queries.ORACLES["op13_jaccard_join"]).fetchall(), key=str) == brute(rows) == result(queries.op13_jaccard_join(spark, str(tmp_path)))


def test_joins_without_broadcasts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "SHARED", 0)
    rows = rows_of(random.Random(31))[:200]
    assert result(parity_join.classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
