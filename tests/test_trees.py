"""Trees grown in one task against plain searches and Spark's own learners."""

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from parcelion.operators import models, trees


def _plain_gain(codes, y, w, feature, cut, least):
    left = codes[:, feature] <= cut
    if min(w[left].sum(), w[~left].sum()) < least:
        return -np.inf
    spread = lambda own: (w[own] * (y[own] - np.average(y[own], weights=w[own])) ** 2).sum()
    return spread(np.full(len(y), True)) - spread(left) - spread(~left)


def test_each_split_is_the_best_of_its_node():
    rng = np.random.default_rng(2)
    bins, n = [7, 2, 5], 400
    codes = np.stack([rng.integers(0, b, n) for b in bins], axis=1).astype(np.uint8)
    y = codes[:, 0] * 2.0 + 3 * (codes[:, 2] > 2) * codes[:, 1] + rng.normal(0, 0.5, n)
    w = rng.integers(0, 4, n).astype(float)
    tree = trees.grow(codes, y, w, bins, 4, 6)
    own = {0: np.flatnonzero(w > 0)}
    for node, feature in enumerate(tree.feature):
        rows = own[node]
        gains = {(f, c): _plain_gain(codes[rows], y[rows], w[rows], f, c, 6) for f in range(3) for c in range(bins[f] - 1)}
        if feature < 0:
            assert np.isclose(tree.value[node], np.average(y[rows], weights=w[rows]))
            continue
        assert np.isclose(gains[feature, tree.cut[node]], max(gains.values())) and np.isclose(tree.gain[node], max(gains.values()))
        left = codes[rows, feature] <= tree.cut[node]
        own[tree.left[node]], own[tree.left[node] + 1] = rows[left], rows[~left]
    assert (tree.feature >= 0).sum() > 5
    want = np.zeros(n)
    for node, rows in own.items():
        want[rows] = tree.value[node] if tree.feature[node] < 0 else want[rows]
    assert np.allclose(tree.predict(codes)[w > 0], want[w > 0])


def test_nodes_counted_in_parts_give_the_same_tree(monkeypatch):
    rng = np.random.default_rng(4)
    codes, y = rng.integers(0, 9, (500, 3)).astype(np.uint8), rng.normal(size=500)
    whole = trees.grow(codes, y, np.ones(500), [9] * 3, 8, 1)
    monkeypatch.setattr(trees, "CELLS", 60)
    monkeypatch.setattr(trees, "HELD", 50)
    parts = trees.grow(codes, y, np.ones(500), [9] * 3, 8, 1)
    assert (whole.feature == parts.feature).all() and (whole.cut == parts.cut).all() and np.allclose(whole.value, parts.value)


def test_bags_are_poisson_and_tell_equal_rows_apart():
    digest = trees.numbered(np.repeat(np.arange(4, dtype=np.int64), 5_000))
    first, second = trees.bag(digest, 0, 42), trees.bag(digest, 1, 42)
    assert len(np.unique(digest)) == 20_000 and abs(first.mean() - 1) < 0.03 and abs(first.var() - 1) < 0.05
    assert abs(np.corrcoef(first, second)[0, 1]) < 0.03 and (first == trees.bag(digest, 0, 42)).all()


def _frame(spark, n=300):
    rows = [(float(i * 7 % 23), float(i * 5 % 11), float((i * 7 % 23) ** 2 + 4 * (i * 5 % 11) + i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, valeur_fonciere double").cache()


def _learner(kind, **settings):
    return kind(featuresCol="_features", labelCol="_label", **settings)


def test_boosting_predicts_as_sparks_learner_does(spark):
    """Also its importances; the values are fewer than the bins, so that both have the same cuts."""
    df, names = _frame(spark), ["a", "b"]
    for settings in ({"maxIter": 1, "maxDepth": 3}, {"maxIter": 6, "maxDepth": 3}):
        own = models.fit("own", models.boosted_trees(**settings), df, names)
        assert isinstance(own.model, trees.Ensemble)
        theirs = models.fit("theirs", _learner(GBTRegressor, stepSize=0.1, seed=42, **settings), df, names)
        both = theirs.predict(own.predict(df, "p"), "q").select("p", "q").toPandas()
        assert np.allclose(both.p, both.q)
    assert np.allclose(own.model.featureImportances.toArray(), theirs.model.featureImportances.toArray(), atol=0.02)


def test_a_forest_is_the_mean_of_bagged_trees(spark):
    df, names = _frame(spark), ["a", "b"]
    found = models.fit("forest", models.random_forest(numTrees=7, maxDepth=5), df, names)
    values = df.select(*names).toPandas().to_numpy(float)
    codes = trees.coded(list(values.T), found.model.edges)
    want = np.mean([tree.predict(codes) for tree in found.model.trees], axis=0)
    assert len(found.model.trees) == 7 and np.allclose(found.predict(df).toPandas().prediction, want)
    again = models.fit("again", models.random_forest(numTrees=7, maxDepth=5), df.repartition(5), names)
    assert all((a.cut == b.cut).all() and np.allclose(a.value, b.value) for a, b in zip(found.model.trees, again.model.trees))
    # Without bagging a tree is Spark's.
    ones = trees.grow(codes, np.array([r[0] for r in df.select("valeur_fonciere").collect()]), np.ones(300), [len(e) + 1 for e in found.model.edges], 4, 5)
    plain = models.fit("tree", _learner(DecisionTreeRegressor, maxDepth=4, minInstancesPerNode=5, maxBins=64), df, names)
    assert np.allclose(ones.predict(codes), plain.predict(df).toPandas().prediction)


def test_more_rows_than_a_task_takes_go_to_sparks_learner(spark, monkeypatch):
    monkeypatch.setattr(trees, "LOCAL_ROWS", 299)
    df = _frame(spark)
    found = models.fit("forest", models.random_forest(numTrees=3, maxDepth=3), df, ["a", "b"])
    assert not isinstance(found.model, trees.Ensemble) and found.model.getNumTrees == 3
    assert models.metrics(found.predict(df)).first().rmse < df.agg(F.stddev_pop("valeur_fonciere")).first()[0]
