"""Whitening against a plain eigen-decomposition of the exact covariance."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from flowlake.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], schema)


def plain(vectors, k=8):
    """n, exact deviations, covariance, eigenvalues and components, straight from the definition."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    far = [int(d) for d in ((n * x - sums) ** 2).sum(axis=1)]
    y = np.array([[float(Fraction(int(n * c - s), n)) for c, s in zip(row, sums)] for row in x])
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    return n, far, y, cov, e[::-1][:k], v[:, ::-1][:, :k]


def check(rows, vectors, digits=1e-8, k=None):
    n, far, y, cov, e, v = plain(vectors)
    k = k or len(e)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(by) == len(rows) == n * len(e)
    z = np.array([[by[i, c + 1]["whitened"] for c in range(k)] for i in range(n)], float)
    for c in range(k):
        expected = y @ v[:, c] / np.sqrt(e[c])
        sign = np.sign(expected @ z[:, c])
        assert np.abs(z[:, c] * sign - expected).max() < digits * max(1, np.abs(expected).max())
        assert by[0, c + 1]["explained"] == pytest.approx(e[c] / np.trace(cov), rel=1e-6)
    assert all(int(by[i, 1]["deviation"]) == far[i] and by[i, 1]["n"] == n for i in range(n))
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]}
    assert rows[0]["identity_error"] < 1e-6


def test_equals_the_plain_decomposition(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)).tolist()
    check(whitening.whitened_embeddings(frame(spark, vectors).repartition(5)).collect(), vectors)


def test_badly_conditioned_rows_keep_their_small_components(spark):
    """Variances over 16 powers of ten: a single Gram matrix loses the last ones."""
    rng = np.random.default_rng(2)
    basis, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    spread = np.array([1e8, 1e7, 1e6, 1e5, 1e4, 1e3, 1e2, 1.0])
    vectors = (rng.normal(size=(400, 8)) * spread) @ basis.T
    x = np.floor(1024 * vectors) + 100_000
    y = x - x.mean(axis=0)
    s = np.linalg.svd(y, compute_uv=False)      # of the rows themselves, never squared
    out = whitening.whitened_embeddings(frame(spark, vectors.tolist())).collect()
    assert out[0]["identity_error"] < 1e-4
    explained = sorted({r["component"]: r["explained"] for r in out}.items())
    np.testing.assert_allclose([e for _, e in explained], s ** 2 / (s ** 2).sum(), rtol=1e-4)


def test_factors_make_the_rows_orthonormal():
    rng = np.random.default_rng(3)
    y = rng.normal(size=(500, 6)) * np.logspace(0, -7, 6)

    def gram_of(factors):
        q = y
        for r in factors:
            q = whitening.forward_substitution(q, r)
        return q.T @ q

    factors, gram = whitening.triangular_factors(gram_of, len(y))
    assert np.abs(gram - np.eye(6)).max() < 1e-10
    assert 1 < len(factors) < whitening.MAX_PASSES
    v, e, total = whitening.principal(factors, gram, len(y), 6)
    s = np.linalg.svd(y, compute_uv=False)
    np.testing.assert_allclose(e, s ** 2 / len(y), rtol=1e-6)
    np.testing.assert_allclose(v.T @ v, np.eye(6), atol=1e-12)


def test_columns_without_variance_have_null_scores(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=50)
    vectors = [[float(c), 2.5, float(c)] for c in a]         # a constant and a copied column
    rows = whitening.whitened_embeddings(frame(spark, vectors)).collect()
    check([r for r in rows], vectors, k=1)
    rest = [r for r in rows if r["component"] > 1]
    assert len(rest) == 100 and all(r["whitened"] is None and r["explained"] == 0 for r in rest)


def test_unusable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [3.0, -1.0], [3.0, -1.0]]
    bad = [None, [], [None, 1.0], [nan, 1.0], [inf, 0.0], [-inf, 0.0], [1e300, 0.0], [1.0], [1.0, 2.0, 3.0]]
    check(whitening.whitened_embeddings(frame(spark, good + bad)).collect(), good)
    assert whitening.whitened_embeddings(frame(spark, bad[:7])).collect() == []
    assert whitening.whitened_embeddings(frame(spark, [])).collect() == []


def test_one_row_and_repeated_rows_have_no_variance(spark):
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 9):
        rows = whitening.whitened_embeddings(frame(spark, vectors)).collect()
        assert len(rows) == 2 * len(vectors)
        assert all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] == 0 for r in rows)


def test_large_entries_are_exact_and_ids_may_repeat_or_be_null(spark):
    vectors = [[2.0 ** 50, -1.0], [-(2.0 ** 50), 5.0], [3.0, 2.0 ** 40], [0.0, 0.0]]
    df = spark.createDataFrame([(None if i == 0 else 7, v, 1, 2.0, "x") for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>, n int, whitened double, component string")
    rows = whitening.whitened_embeddings(df).collect()
    _, far, *_ = plain(vectors)
    assert sorted({int(r["deviation"]) for r in rows}) == sorted(set(far))
    assert len(rows) == 8 and {r["vec_id"] for r in rows} == {None, 7}
