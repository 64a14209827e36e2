"""Figures without a fold against numpy."""

import random

import numpy as np
import pytest

from parcelion.operators import foldstats


def test_every_fold_equals_the_rows_left(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["01", "01", "01", "75"]), rng.randrange(5), float(rng.choice([1e5, 2e5, round(rng.uniform(1, 1e6), 1)])), float(rng.randrange(9, 200))) for _ in range(800)]
    rows += [("13", 2, 5.0, 1.0), ("13", 2, 7.0, 2.0), ("20", 0, 4.0, 1.0), ("20", 1, 9.0, 3.0), ("20", 1, None, None)]
    frame = spark.createDataFrame(rows, "departement string, pli int, valeur_fonciere double, surface_reelle_bati double").repartition(4)
    found = {(r.departement, r.held): r for r in foldstats.department_folds(frame, ["departement"]).collect()}
    expected = set()
    for dept in {r[0] for r in rows}:
        for held in range(5):
            left = [r for r in rows if r[0] == dept and r[1] != held and r[2] is not None]
            if not left:
                continue
            expected.add((dept, held))
            price, surface = np.array([r[2] for r in left]), np.array([r[3] for r in left])
            row = found[dept, held]
            assert row.dept_count_trans == len(left) and row.dept_median_price == np.median(price)
            assert np.isclose(row.dept_mean_price, price.mean(), rtol=1e-12) and np.isclose(row.dept_mean_surface, surface.mean(), rtol=1e-12)
            assert row.dept_std_price is None if len(left) == 1 else np.isclose(row.dept_std_price, price.std(ddof=1), rtol=1e-10)
    assert set(found) == expected


@pytest.mark.parametrize("rows", [[], [("01", 0, None, None)]])
def test_nothing_to_tell(spark, rows):
    frame = spark.createDataFrame(rows, "departement string, pli int, valeur_fonciere double, surface_reelle_bati double")
    assert foldstats.department_folds(frame, ["departement"]).collect() == []
