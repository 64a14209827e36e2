"""Gram-matrix models against the normal equations of numpy."""

import numpy as np
import pytest

from parcelion.operators import gram


def _rows(spark, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3)) * [1, 50, 3] + [0, 1000, -2]
    y = x @ [2.0, -0.5, 7.0] + rng.normal(size=n) + 10_000
    return [(int(1 + i % 2), int(i % 5), *map(float, x[i]), float(x[i, 0] * 2 - x[i, 2]), 4.0, float(y[i])) for i in range(n)]


SCHEMA = "g int, pli int, a double, b double, c double, d double, e double, y double"


def _plain(x, y, alpha, width):
    xc, yc = x - x.mean(0), y - y.mean()
    b = np.linalg.solve(xc.T @ xc + alpha * np.diag(width**2), xc.T @ yc)
    return np.concatenate([[y.mean() - x.mean(0) @ b], b])


@pytest.mark.parametrize("alpha", [0.0, 25.0])
def test_coefficients_and_folds_equal_the_normal_equations(spark, alpha):
    rows = _rows(spark)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    width = np.array([1.0, 60.0, 2.0])
    found = gram.group_models(frame, "g", "pli", ["a", "b", "c"], "y", {1: width, 2: width})
    table = np.array(rows)
    for group in (1, 2):
        own = table[table[:, 0] == group]
        x, y = own[:, 2:5], own[:, 7]
        assert np.allclose(list(found.coefficients(group, alpha).values()), _plain(x, y, alpha, width), rtol=1e-8)
        folds = found.folds(group, alpha)
        assert [f[0] for f in folds] == sorted(set(own[:, 1]))
        for fold, learnt, held, rmse, r2 in folds:
            out = own[:, 1] == fold
            model = _plain(x[~out], y[~out], alpha, width)
            gap = y[out] - model[0] - x[out] @ model[1:]
            assert (learnt, held) == ((~out).sum(), out.sum())
            assert np.isclose(rmse, (gap**2).mean() ** 0.5, rtol=1e-8) and np.isclose(r2, 1 - (gap**2).sum() / ((y[out] - y[out].mean()) ** 2).sum())


def test_columns_that_others_make_up_count_nothing(spark):
    rows = _rows(spark)
    found = gram.group_models(spark.createDataFrame(rows, SCHEMA), "g", "pli", ["a", "e", "c", "d"], "y")
    table = np.array(rows)
    for group in (1, 2):
        own = table[table[:, 0] == group]
        model = found.coefficients(group)
        assert model["e"] == model["d"] == 0
        assert np.allclose([model["a"], model["c"]], _plain(own[:, [2, 4]], own[:, 7], 0, np.ones(2))[1:], rtol=1e-8)


def test_no_rows(spark):
    found = gram.group_models(spark.createDataFrame([], SCHEMA), "g", "pli", ["a"], "y")
    assert found.groups() == []
