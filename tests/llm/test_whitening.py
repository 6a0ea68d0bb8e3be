"""Whitening against numpy on exact arithmetic, also where sums without centring would lose everything."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tidewell.llm import whitening


def brute(rows, most=4, scale=256):
    """vec_id -> (deviation, whitened up to sign), n, explained; rows: (id, vector)."""
    xs = {}
    left = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        left.append((i, [math.floor(scale * c) for c in v]))
    dim = max((len(x) for _, x in left), default=0)
    left = [(i, tuple(x + [0] * (dim - len(x)))) for i, x in left]
    xs = sorted({x for _, x in left})
    n = len(xs)
    s = [sum(x[k] for x in xs) for k in range(dim)]
    c = np.array([[float(Fraction(n * x[k] - s[k], n)) for k in range(dim)] for x in xs])
    cov = c.T @ c / n
    val, vec = np.linalg.eigh(cov)
    val, vec = val[::-1][:most], vec[:, ::-1][:, :most]
    dev = [sum((n * a - b) ** 2 for a, b in zip(x, s)) for _, x in left]
    w = np.array([[float(Fraction(n * x[k] - s[k], n)) for k in range(dim)] for _, x in left]) @ vec / np.sqrt(val)
    return [(i, dev[j], w[j]) for j, (i, _) in enumerate(left)], n, val / np.trace(cov)


def vectors(rng, count, dim, offset=0.0, spread=1.0):
    mix = np.random.default_rng(rng.randrange(10**6)).normal(size=(dim, dim)) * np.linspace(2, 0.2, dim)[:, None]
    return [[float(c) for c in offset + spread * (np.random.default_rng(rng.randrange(10**9)).normal(size=dim) @ mix)] for _ in range(count)]


@pytest.mark.parametrize(("dim", "offset", "spread"), [(6, 0.0, 0.1), (12, 3.0, 1.0), (5, 1e7, 0.5), (3, 1e12, 40.0)])
def test_whitening_against_exact_numbers(spark, dim, offset, spread):
    rng = random.Random(dim)
    rows = list(enumerate(vectors(rng, 300, dim, offset, spread)))
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(7, rows[8][1]), (None, rows[9][1])]
    rows += [(5000, None), (5001, [math.nan] + [0.0] * (dim - 1)), (5002, [None] * dim), (5003, [math.inf] * dim)]
    want, n, explained = brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = whitening.whiten(df).collect()
    k = min(4, dim)
    assert len(got) == k * len(want) and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, k + 1))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    signs = {}
    exact = {(i, d): w for i, d, w in want}
    for r in got:
        w = exact[r.vec_id, r.deviation if r.deviation is not None else next(d for i, d, _ in want if i == r.vec_id)][r.component - 1]
        if abs(w) > 1e-3:
            signs.setdefault(r.component, set()).add(math.copysign(1, w * r.whitened))
        assert math.isclose(abs(w), abs(r.whitened), rel_tol=1e-6, abs_tol=1e-7)
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        assert (r.deviation is None) == (next(d for i, d, _ in want if i == r.vec_id) >= 1 << 63) or r.vec_id in (7, None)
    assert all(len(s) == 1 for s in signs.values())


def test_merging_in_any_order_is_merging_at_once():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (400, 5)) + 10**9
    parts = [whitening.moments(p) for p in np.split(x, [1, 7, 30, 31, 250])]
    one = whitening.nothing()
    for p in parts:
        one = whitening.merged(one, p)
    two = whitening.merged(whitening.merged(parts[5], parts[0]), whitening.merged(whitening.merged(parts[3], parts[4]), whitening.merged(parts[2], parts[1])))
    exact = (x * 400 - x.sum(0)) / 400
    for n, s, m in (one, two):
        assert n == 400 and s == x.sum(0).tolist()
        assert np.allclose(m, exact.T @ exact, rtol=1e-12)


def test_odd_vectors(spark):
    kind = "vec_id long, embedding array<float>, VEC_ID_ int, n long"
    rows = [(1, [0.5, -0.0, 0.25]), (2, [0.5]), (2, [0.5, 0.0, 0.0]), (3, []), (4, [3e38, -3e38]), (None, [1.0]), (5, [None]), (6, None)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], kind).withColumnRenamed("VEC_ID_", "VEC_ID")
    got = whitening.whiten(df).collect()
    assert len(got) == 6 * 3 and {r.n for r in got} == {5}  # rows of 2 are equal with zeros at the end, that of 3 is all zeros
    a, b = (sorted((r.component, r.deviation, r.whitened) for r in got if r.vec_id == 2)[i::2] for i in (0, 1))
    assert a == b
    assert {r.deviation for r in got if r.vec_id == 4} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [float("nan")])], [(1, [])]])
def test_no_vectors(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_one_vector_and_directions_without_variance(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in got] == [(1, 0, None, 0.0)] * 4
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [2.0, 4.0, 0.0])], "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id, r.component, r.whitened is None) for r in got) == [(v, c, c > 1) for v in (1, 2) for c in (1, 2, 3)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 for r in got if r.component == 1)
