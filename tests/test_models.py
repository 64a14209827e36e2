"""Splits, learners, metrics, leakage and projection."""

import math
import random
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from parcelion.operators import features, models

FOREST = {"numTrees": 5, "maxDepth": 4}


def _rows(spark, n=600):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        surface = float(rnd.randint(20, 250))
        dept = rnd.choice(["01", "13", "75"])
        price = 3000 * surface + {"01": 0, "13": 50_000, "75": 200_000}[dept] + rnd.gauss(0, 5_000)
        rows.append((f"id{i}", date(2020, 1 + i % 12, 1 + i % 28) if i else date(2020, 2, 29), price, f"{dept}000", dept, surface, 1 + i % 6, 2020, 1 + i % 12))
    df = spark.createDataFrame(rows, "id_unique string, date_mutation date, valeur_fonciere double, code_postal string, departement string, surface_reelle_bati double, nombre_pieces_principales int, annee int, mois int")
    return df.withColumn("prix_m2", F.col("valeur_fonciere") / F.col("surface_reelle_bati"))


def test_lots_cover_all_rows_once_and_never_move(spark):
    df = _rows(spark)
    first = {r.id_unique: r.lot for r in models.with_lot(df).collect()}
    again = {r.id_unique: r.lot for r in models.with_lot(df.repartition(5)).collect()}
    assert first == again
    share = sum(v == "train" for v in first.values()) / len(first)
    assert 0.74 < share < 0.86 and set(first.values()) == {"train", "val", "test"}
    assert sum(p.count() for p in models.lots(models.with_lot(df))) == len(first)
    assert {r.pli for r in models.with_fold(df).collect()} == {0, 1, 2, 3, 4}


def test_metrics_match_numpy(spark):
    pairs = [(0.0, 1.0), (2.0, 1.0), (4.0, 5.0), (10.0, 7.0)]
    row = models.metrics(spark.createDataFrame(pairs, "valeur_fonciere double, prediction double")).first()
    y, p = np.array(pairs).T
    e = y - p
    assert math.isclose(row.mse, (e**2).mean()) and math.isclose(row.rmse, (e**2).mean() ** 0.5)
    assert math.isclose(row.mae, abs(e).mean())
    assert math.isclose(row.r2, 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert math.isclose(row.mape, 100 * abs(e[1:] / y[1:]).mean())


def test_least_squares_and_ridge_match_the_normal_equations(spark):
    df = _rows(spark, 200).cache()
    names = ["surface_reelle_bati", "nombre_pieces_principales"]
    table = df.select("valeur_fonciere", *names).toPandas()
    x, y = table[names].to_numpy(float), table.valeur_fonciere.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    for learner, alpha in ((models.linear_regression(), 0.0), (models.ridge(df, alpha=500.0), 500.0)):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
        fitted = models.fit("m", learner, df, names)
        assert np.allclose(fitted.model.coefficients.toArray(), want, rtol=1e-6)
        assert math.isclose(fitted.model.intercept, y.mean() - x.mean(0) @ want, rel_tol=1e-6)


def test_learners_beat_the_mean_and_are_ranked(spark):
    df = models.with_lot(_rows(spark)).cache()
    train, val, _ = models.lots(df)
    names = ["surface_reelle_bati", "nombre_pieces_principales", "mois"]
    fitted, seconds = models.train_all(train, names, FOREST, {"maxIter": 3, "maxDepth": 3})
    board = models.leaderboard(models.compare(fitted, val)).collect()
    assert [r.rmse for r in board] == sorted(r.rmse for r in board) and len(board) == len(seconds) == 4
    spread = val.agg(F.stddev_pop("valeur_fonciere")).first()[0]
    assert all(r.rmse < spread for r in board)
    assert next(r for r in board if r.modele == "Linear Regression").gain_pct == 0
    assert models.importances(fitted[2])[0][0] == "surface_reelle_bati"
    information = models.mutual_information(train, names).collect()
    assert information[0].variable == "surface_reelle_bati"


def test_log_target_is_turned_back(spark):
    df = spark.createDataFrame([(float(i), math.expm1(0.1 * i)) for i in range(50)], "x double, valeur_fonciere double")
    assert models.needs_log(df)
    fitted = models.fit("log", models.linear_regression(), df, ["x"], log_target=True)
    assert models.metrics(fitted.predict(df)).first().rmse < 1e-6


def test_department_figures_come_from_training_rows_only(spark):
    df = models.with_lot(_rows(spark)).cache()
    before = {r.departement: r.dept_mean_price for r in models.safe_lots(df).stats.table.collect()}
    # Prices outside the training lot do not change what was learnt.
    moved = df.withColumn("valeur_fonciere", F.when(F.col("lot") == "train", F.col("valeur_fonciere")).otherwise(1e9))
    safe = models.safe_lots(moved)
    assert {r.departement: r.dept_mean_price for r in safe.stats.table.collect()} == before
    assert "ratio_prix_dept" not in safe.val.columns
    assert "ratio_prix_dept" in models.safe_lots(moved, parity=True).val.columns
    unseen = safe.stats.apply(df.limit(1).withColumn("departement", F.lit("99"))).first()
    assert unseen.dept_mean_price is None


def test_leaking_features_show(spark):
    df = models.with_lot(_rows(spark)).cache()
    train, val, _ = models.lots(df)
    honest = ["surface_reelle_bati", "nombre_pieces_principales", "mois"]
    scores = [models.metrics(models.fit("m", models.random_forest(**FOREST, ), train, names).predict(val)).first().rmse
              for names in (honest, [*honest, "prix_m2"])]
    assert scores[1] < scores[0]


def test_cross_validation_reads_every_row_once(spark):
    df = models.with_fold(_rows(spark, 200)).cache()
    row = models.cross_validate(models.linear_regression, df, ["surface_reelle_bati"]).first()
    assert row.plis == 5 and row.rmse_min <= row.rmse_moyen <= row.rmse_max


def test_projection_moves_the_date_and_keeps_the_price_out(spark):
    df = models.with_lot(_rows(spark, 300)).cache()
    safe = models.safe_lots(df)
    found = models.project(df, safe, 2025, models.random_forest(**FOREST)).cache()
    assert found.count() == 300
    assert {r.annee for r in found.collect()} == {2025}
    assert found.where("id_unique = 'id0'").first().date_mutation == date(2025, 2, 28)
    # The source month stays, and other prices of the projected rows give the same answer.
    other = models.project(df.withColumn("valeur_fonciere", F.lit(1.0)).withColumn("prix_m2", F.lit(1.0)), safe, 2025, models.random_forest(**FOREST))
    pick = lambda frame: {r.id_unique: r[models.PREDICTION] for r in frame.collect()}
    assert pick(found) == pick(other)
    assert models.by_department(found).count() == 3
    assert models.by_month(found, "75").where("departement <> '75'").count() == 0
    assert models.dearest_and_cheapest(found, 2).count() == 4
    assert {r.departement for r in models.largest_departments(found, 1).select("departement").collect()} <= {"01", "13", "75"}
    assert models.department_comparison(df, found).count() == 3
    assert {r.source for r in models.observed_and_predicted(df, found).collect()} == {"reel", "predit"}


def test_combined_frames(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    two = spark.createDataFrame([(3, 4)], "a int, c int")
    assert features.combine([one, two]).columns == ["a"]
    both = features.combine([one, two], common_only=False)
    assert sorted(tuple(r) for r in both.collect()) == [(1, 2, 0), (3, 0, 4)]
