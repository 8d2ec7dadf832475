"""Whitening against a dense eigenvalue solver."""

import math

import numpy as np
import pytest

from tidemill.llm.whitening import bidiagonalise, fit_whitening, whiten

KIND = "vec_id long, embedding array<float>"


def dense(vectors):
    """Grid rows, fit list, eigenvalues (falling), eigenvectors by rows."""
    x = np.floor(256 * np.asarray(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, values[::-1], columns.T[::-1]


def rows_of(vectors):
    return [(i, [float(e) for e in v]) for i, v in enumerate(vectors)]


def test_components_equal_those_of_a_dense_solver(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(0.1, 1, 12)).astype(np.float32)
    vectors = np.concatenate([vectors, np.repeat(vectors[:3], 40, axis=0)])
    x, fit, values, found = dense(vectors)
    got = whiten(spark.createDataFrame(rows_of(vectors), KIND)).toPandas()
    assert len(got) == 4 * len(vectors) and set(got.n) == {len(fit)}
    exact = [sum((len(fit) * int(e) - int(s)) ** 2 for e, s in zip(row, fit.sum(axis=0)))
             for row in x]
    for k in range(4):
        part = got[got.component == k + 1].sort_values("vec_id")
        want = (x - fit.mean(axis=0)) @ found[k] / math.sqrt(values[k])
        sign = np.sign(want @ part.whitened)
        assert np.allclose(part.whitened * sign, want, atol=1e-9)
        assert np.allclose(part.explained, values[k] / values.sum(), rtol=1e-10)
        assert part.deviation.tolist() == exact
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_repeated_eigenvalues_are_all_found(spark):
    corners = [(a, b, c) for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    got = whiten(spark.createDataFrame(rows_of(corners), KIND)).toPandas()
    assert set(got.component) == {1, 2, 3}
    assert np.allclose(got.explained, 1 / 3) and got.identity_error.iloc[0] < 1e-12


def test_fewer_steps_find_the_separated_components(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((400, 20)) * np.array([9, 5, 3, 2] + [0.05] * 16)
    _, _, values, _ = dense(vectors)
    got = whiten(spark.createDataFrame(rows_of(vectors), "vec_id long, embedding array<double>"),
                 steps=10).toPandas()
    for k in range(4):
        assert np.allclose(got[got.component == k + 1].explained, values[k] / values.sum(),
                           rtol=1e-4)


def test_bidiagonal_matrix_reproduces_the_products(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (60, 6))
    fit = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>")
    matrix, right = bidiagonalise(fit, x.mean(axis=0), 6)
    assert np.allclose(np.triu(np.tril(matrix, 1)), matrix)
    assert np.allclose(right.T @ right, np.eye(6), atol=1e-13)
    centred = x - x.mean(axis=0)
    assert np.allclose(right.T @ centred.T @ centred @ right, matrix.T @ matrix, atol=1e-8)


def test_vectors_that_lack_entries_are_dropped(spark):
    rows = [(1, [0.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]),
            (5, [math.inf, 1.0]), (6, [1.0]), (7, [0.25, -0.5]), (None, [0.0, 0.5]), (8, []),
            (7, [0.25, -0.5]), (9, [-1.0, 0.75])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                  KIND + ", component int, x string")
    got = whiten(table).toPandas()
    assert sorted(got.vec_id.fillna(-1)) == [-1, -1, 1, 1, 7, 7, 7, 7, 9, 9]
    assert set(got.n) == {3} and list(got.columns) == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whiten(spark.createDataFrame(rows, KIND)).collect() == []


def test_no_variance(spark):
    got = whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], KIND)).collect()
    assert len(got) == 4 and {(r.n, r.deviation, r.whitened, r.explained) for r in got} == {
        (1, 0, None, None)}


def test_one_constant_dimension(spark):
    got = whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.25, 1.0])], KIND)).collect()
    assert [r.whitened for r in got if r.component == 2] == [None, None]
    assert sorted(r.whitened for r in got if r.component == 1) == pytest.approx([-1, 1])


def test_deviations_past_a_long_are_null(spark):
    got = whiten(spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.0])], KIND))
    by_id = {r.vec_id: r.deviation for r in got.collect()}
    assert by_id[1] is None and by_id[3] is not None


def test_negative_zero_is_zero(spark):
    fit = spark.createDataFrame([([0, 1],), ([0, 3],)], "x array<long>")
    assert fit_whitening(fit).n == 2
    assert {r.n for r in whiten(spark.createDataFrame(
        [(1, [-0.0, 1.0]), (2, [0.0, 1.0])], KIND)).collect()} == {1}
