"""Registered model queries learn from every training row."""

import random
from datetime import date, timedelta
from types import SimpleNamespace

import pytest

from parcelion.operators import features, models
from parcelion.plans import analysis, queries

from .data import bronze, sale


def _segment(spark, n=3_300):
    """Cleaned rows of the second segment, one per key."""
    rnd = random.Random(3)
    rows = [
        (*sale(date(2020, 1, 1) + timedelta(days=i % 700), price=500_000.0 + 100 * i, postal=f"{10 + i % 5}{i % 10}00", surface=float(rnd.randint(20, 200)), rooms=1 + i % 6), f"key{i}", date(2025, 1, 1), 2)
        for i in range(n)
    ]
    names = [*bronze(spark, []).columns, "id_unique", "part_date", "segment"]
    types = [f.dataType.simpleString() for f in bronze(spark, []).schema] + ["string", "date", "int"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(names, types))).cache()


@pytest.fixture
def learnt(spark, monkeypatch):
    """Numbers of rows that learners are given, with a line in place of every learner."""
    seen = []

    def fit(name, learner, train, columns, *args, **kw):
        seen.append(train.count())
        return models.Fitted(name, SimpleNamespace(transform=lambda df: df.selectExpr("*", "1D AS prediction")), list(columns))

    rows = _segment(spark)
    built = models.with_lot(features.engineered(rows)).cache()
    monkeypatch.setattr(models, "fit", fit)
    monkeypatch.setattr(models, "compare", lambda fitted, val: None)
    monkeypatch.setattr(models, "leaderboard", lambda scores: spark.createDataFrame([("x",)], "modele string"))
    monkeypatch.setattr(queries, "stored_features", lambda *_: built)
    monkeypatch.setattr(queries, "stored_segments", lambda *_: rows)
    monkeypatch.setattr(queries, "second_segment", lambda *_: rows)
    monkeypatch.setattr(queries, "_PREPARED", {})
    train = built.where("lot = 'train'")
    assert train.count() > 2_500
    return seen, train


def test_every_fold_learns_from_all_other_rows(spark, learnt):
    seen, train = learnt
    queries.model_cross_validation(spark, "own rows")
    sizes = [r["count"] for r in models.with_fold(train).groupBy("pli").count().orderBy("pli").collect()]
    assert seen == [train.count() - n for n in sizes]


def test_the_leakage_study_learns_from_all_rows(spark, learnt):
    seen, train = learnt
    queries.model_leakage(spark, "own rows")
    assert seen == [train.count()] * 3


def test_the_four_regressors_learn_from_all_rows(spark, learnt):
    """They serve the leaderboard, the test score and the importances."""
    seen, train = learnt
    queries._learnt(spark, "own rows", 2)
    assert seen == [train.count()] * 4


def test_the_projection_learns_from_all_rows(spark, learnt):
    seen, train = learnt
    assert queries._projection(spark, "own rows").count() == 3_300
    assert seen == [train.count()] and "rows" not in analysis.study.__code__.co_varnames[: analysis.study.__code__.co_argcount]
