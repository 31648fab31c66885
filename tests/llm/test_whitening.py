"""Whitening against a plain eigendecomposition in exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sediment.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """{vec_id: deviation}, eigenvalues, eigenvectors, centred rows and the covariance."""
    own = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v, _ in rows]
    x = np.array([v for _, v in own], object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    cov = (centred.T @ centred).astype(object)
    v = np.array([[float(Fraction(int(a), n ** 3)) for a in row] for row in cov])
    values, vectors = np.linalg.eigh(v)
    return ([i for i, _ in own], (centred ** 2).sum(axis=1).tolist(), values[::-1], vectors[:, ::-1],
            (centred / n).astype(float), v)


def spread(rng, n, d):
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    return (rng.normal(size=(n, d)) * 0.9 ** np.arange(d)) @ turn


def rows_of(m):
    return [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(m)]


@pytest.mark.parametrize(("n", "d"), [(400, 64), (300, 40), (200, 6), (60, 3)])
def test_whitening(spark, n, d):
    rows = rows_of(spread(np.random.default_rng(n), n, d))
    got = whitening.contract(spark.createDataFrame(rows, VECTORS)).collect()
    ids, deviation, values, vectors, c, v = brute(rows)
    k = min(8, d)
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    assert {(r["vec_id"], r["deviation"]) for r in got} == set(zip(ids, deviation, strict=True))
    want = (c @ vectors[:, :k]) / np.sqrt(values[:k])
    mine = np.zeros((n, k))
    for r in got:
        mine[r["vec_id"], r["component"] - 1] = r["whitened"]
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * sign - want).max() < 1e-9
    for r in got[:k]:
        assert math.isclose(r["explained"], values[r["component"] - 1] / np.trace(v), rel_tol=1e-12)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-10


def test_clustered_spectrum_is_certified(spark):
    """Neighbouring eigenvalues a thousandth apart, and no gap behind the block."""
    rng = np.random.default_rng(3)
    m = rng.normal(size=(500, 64)) * np.linspace(1.0, 0.94, 64)
    x = whitening.integers(spark.createDataFrame(rows_of(m), VECTORS))
    fit = whitening.Whitening(spark, x)
    *_, values, vectors, _, v = brute(rows_of(m))
    assert np.allclose(fit.eigenvalues, values[:8], rtol=1e-12)
    residual = v @ fit.components - fit.components * fit.eigenvalues
    assert np.linalg.norm(residual, axis=0).max() < 1e-12 * values[0]
    assert fit.passes.count > 2 * whitening.DEGREE  # the filter did the work


def test_filter_damps_the_unwanted_part():
    values = np.linspace(1, 100, 50)
    q = np.eye(50)
    got = whitening.chebyshev(lambda y: values[:, None] * y, q, values[:, None] * q, 12, 60.0, 100.0)
    damped = np.abs(np.diag(got))
    assert damped[values <= 60].max() < 1e-5 and math.isclose(damped[-1], 1.0) and (np.diff(damped[values > 60]) > 0).all()


def test_odd_rows(spark):
    m = spread(np.random.default_rng(9), 30, 5)
    plain = rows_of(m)
    odd = [(100, None, 0), (101, [1.0, None, 0.0, 0.0, 0.0], 0), (102, [float("nan")] * 5, 0),
           (103, [float("inf")] + [0.0] * 4, 0), (106, [1e38] * 5, 0), (104, [], 0), (105, [1.0, 2.0], 0)]
    want = sorted(map(tuple, whitening.contract(spark.createDataFrame(plain, VECTORS)).collect()))
    got = sorted(map(tuple, whitening.contract(spark.createDataFrame(plain + odd, VECTORS)).collect()))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], atol=1e-9)
    # Repeated rows and a null id count each.
    twice = plain + plain[:3] + [(None, plain[0][1], 0)]
    assert whitening.contract(spark.createDataFrame(twice, VECTORS)).count() == 34 * 5


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(9)]])
def test_no_spread_gives_no_rows(spark, rows):
    assert whitening.contract(spark.createDataFrame(rows, VECTORS)).count() == 0


def test_rank_deficient(spark):
    """Two directions only: two components."""
    rng = np.random.default_rng(4)
    m = [[float(a), float(b), float(a), 0.0] for a, b in rng.integers(-50, 50, size=(200, 2))]
    got = whitening.contract(spark.createDataFrame([(i, v, 0) for i, v in enumerate(m)], VECTORS)).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-9


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(np.random.default_rng(2).integers(-2 ** 49, 2 ** 49, size=(70, 3)))]
    got = whitening.contract(spark.createDataFrame(rows, VECTORS)).collect()
    ids, deviation, *_ = brute(rows)
    want = {i: v if v < 2 ** 63 else None for i, v in zip(ids, deviation, strict=True)}
    assert {r["vec_id"]: r["deviation"] for r in got} == want
