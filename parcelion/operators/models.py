"""Splits, distributed regressors, evaluation, leakage study and projection."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelion.functions.dates import move_to_year
from parcelion.functions.text import hex_decile
from parcelion.operators import trees
from parcelion.operators.distribution import spread, summarize
from parcelion.operators.explore import group_summary, with_department
from parcelion.operators.features import (
    DepartmentStats, column_quantiles, drop_prefixed, leak_free, numeric_columns, training_stats,
)

TARGET = "valeur_fonciere"
PREDICTION = "valeur_fonciere_predite"
NOT_FEATURES = (TARGET, "segment")


# --- splits ---------------------------------------------------------------------------


def with_lot(df: DataFrame, identity: str = "id_unique", seed: int = 42) -> DataFrame:
    """``lot`` = train (8 of 10), val (1) or test (1), by a salted digest of the row's
    identity: the same on every run, cluster and partitioning."""
    decile = hex_decile(F.sha2(F.concat(F.col(identity), F.lit(f":{seed}")), 256))
    return df.withColumn(
        "lot", F.when(decile < 8, "train").when(decile == 8, "val").otherwise("test")
    )


def with_fold(df: DataFrame, folds: int = 5, identity: str = "id_unique", seed: int = 42) -> DataFrame:
    """``pli`` = 0..folds-1, from other digits of the digest than ``lot``."""
    digest = F.sha2(F.concat(F.col(identity), F.lit(f":{seed}")), 256)
    number = F.conv(F.substring(digest, 9, 4), 16, 10).cast("int")
    return df.withColumn("pli", F.floor(number * folds / 65536).cast("int"))


def lots(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training, validation and test rows of a frame with ``lot``."""
    return tuple(df.where(F.col("lot") == name).drop("lot") for name in ("train", "val", "test"))


# --- target ---------------------------------------------------------------------------


def needs_log(train: DataFrame, column: str = TARGET, limit: float = 1.5) -> bool:
    """Whether the target is skewed enough to be learnt as log(1 + y)."""
    skew = train.agg(F.skewness(column)).first()[0]
    return skew is not None and not math.isnan(skew) and abs(skew) > limit


# --- learners -------------------------------------------------------------------------


@dataclass(frozen=True)
class Fitted:
    """A fitted regressor with the columns it reads."""

    name: str
    model: Model | trees.Ensemble
    features: list[str]
    log_target: bool = False

    def predict(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        """Rows with the prediction; columns the frame does not have count as 0."""
        missing = {c: F.lit(0.0) for c in self.features if c not in df.columns}
        ready = _assemble(df.withColumns(missing) if missing else df, self.features)
        scored = self.model.transform(ready).drop("_features", *missing)
        if self.log_target:
            scored = scored.withColumn("prediction", F.expm1("prediction"))
        return scored if column == "prediction" else scored.withColumnRenamed("prediction", column)


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(features), outputCol="_features", handleInvalid="error"
    ).transform(df)


def linear_regression(**kw):
    return LinearRegression(featuresCol="_features", labelCol="_label", regParam=0.0, **kw)


def ridge(train: DataFrame, alpha: float = 1.0, label: str = TARGET, **kw):
    """Least squares with ``alpha`` times the squared coefficients added to the squared
    error.

    The learner minimises half the mean squared error of the target divided by its
    population deviation, hence the scaling of its parameter.
    """
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LinearRegression(
        featuresCol="_features", labelCol="_label", regParam=alpha * row["s"] / row["n"],
        elasticNetParam=0.0, standardization=False, **kw,
    )


def random_forest(**kw):
    settings = {
        "numTrees": 100, "maxDepth": 15, "minInstancesPerNode": 5,
        "featureSubsetStrategy": "all", "seed": 42, "maxBins": 64, **kw,
    }
    return trees.Learner(**settings)


def boosted_trees(**kw):
    settings = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "minInstancesPerNode": 1, "seed": 42, "maxBins": 32, **kw}
    return trees.BoostedLearner(**settings)


def fit(name: str, learner, train: DataFrame, features: Sequence[str], label: str = TARGET,
        log_target: bool = False) -> Fitted:
    """Fit a learner on the given columns; the target may be learnt as log(1 + y)."""
    y: Column = F.col(label).cast("double")
    ready = _assemble(train, features).select("_features", (F.log1p(y) if log_target else y).alias("_label"))
    return Fitted(name, learner.fit(ready), list(features), log_target)


def default_features(df: DataFrame) -> list[str]:
    """All numeric columns except the target and the segment number."""
    return numeric_columns(df, NOT_FEATURES)


# --- evaluation -----------------------------------------------------------------------


def metrics(scored: DataFrame, keys: Sequence[str] = (), label: str = TARGET,
            prediction: str = "prediction") -> DataFrame:
    """MSE, RMSE, MAE, R² and MAPE (rows with a target of 0 left out) per group, in one
    aggregate."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    n = F.count(F.lit(1))
    figures = [
        n.alias("n"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), n * F.var_pop(y))).alias("r2"),
        F.coalesce(F.avg(F.when(y != 0, F.abs(e / y))) * 100, F.lit(0.0)).alias("mape"),
    ]
    return scored.groupBy(*keys).agg(*figures) if keys else scored.agg(*figures)


def residuals(scored: DataFrame, keys: Sequence[str] = (), label: str = TARGET,
              prediction: str = "prediction") -> DataFrame:
    """Mean, population deviation and exact median of target minus prediction."""
    gap = scored.withColumn("residu", F.col(label) - F.col(prediction))
    return summarize(gap, keys, ["residu"]).select(
        *keys, F.col("mean").alias("moyenne"), F.col("std_pop").alias("ecart_type"),
        F.col("p50").alias("mediane"),
    )


def compare(models: Sequence[Fitted], rows: DataFrame, label: str = TARGET) -> DataFrame:
    """Metrics of several models on one frame: each adds its prediction column, and one
    aggregate serves all."""
    scored = rows
    for i, fitted in enumerate(models):
        scored = fitted.predict(scored, f"_p{i}")
    cells = F.array(
        *[
            F.struct(F.lit(m.name).alias("modele"), F.col(f"_p{i}").alias("prediction"))
            for i, m in enumerate(models)
        ]
    )
    return metrics(scored.select(F.col(label), F.inline(cells)), ["modele"], label)


def leaderboard(scores: DataFrame, baseline: str = "Linear Regression") -> DataFrame:
    """Models by RMSE with the gain in percent over the linear baseline. The window holds
    one row per model."""
    base = F.max(F.when(F.col("modele") == baseline, F.col("rmse"))).over(Window.partitionBy(F.lit(1)))
    return scores.withColumn("gain_pct", (base - F.col("rmse")) / base * 100).orderBy("rmse", "modele")


def importances(fitted: Fitted, rows: int = 10) -> list[tuple[str, float]]:
    """Tree importances, or absolute coefficients, largest first."""
    model = fitted.model
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
    else:
        weights = [abs(w) for w in model.coefficients.toArray()]
    ranked = sorted(zip(fitted.features, map(float, weights)), key=lambda p: (-p[1], p[0]))
    return ranked[:rows]


def importance_table(spark: SparkSession, fitted: Fitted, rows: int = 10) -> DataFrame:
    ranked = [(i + 1, n, w) for i, (n, w) in enumerate(importances(fitted, rows))]
    return spark.createDataFrame(ranked, "rang int, variable string, importance double")


def mutual_information(train: DataFrame, columns: Sequence[str], label: str = TARGET,
                       bins: int = 10) -> DataFrame:
    """Mutual information of each column with the target, both cut at their quantiles.

    Cell counts are combined before the shuffle: at most bins x bins per column travel.
    """
    steps = tuple(i / bins for i in range(1, bins))
    cuts = column_quantiles(train, [*columns, label], steps)

    def place(column: str) -> Column:
        value = F.col(f"`{column}`")
        found = F.lit(0)
        for bound in sorted(set(cuts[column])):
            found = found + (value > bound).cast("int")
        return found

    cells = F.array(
        *[F.struct(F.lit(c).alias("variable"), place(c).alias("x")) for c in columns]
    )
    joint = (
        train.select(place(label).alias("y"), F.inline(cells))
        .groupBy("variable", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("variable"))
    of_x = F.sum("n").over(Window.partitionBy("variable", "x"))
    of_y = F.sum("n").over(Window.partitionBy("variable", "y"))
    share = F.col("n") / total
    return (
        joint.withColumn("part", share * F.ln(F.col("n") * total / (of_x * of_y)))
        .groupBy("variable")
        .agg(F.sum("part").alias("information"))
        .orderBy(F.desc("information"), "variable")
    )


def cross_validate(make: Callable[[], object], train: DataFrame, features: Sequence[str],
                   folds: int = 5, label: str = TARGET) -> DataFrame:
    """RMSE over the folds: mean, population deviation, smallest and largest.

    ``train`` carries ``pli`` from :func:`with_fold`; pass a stored or cached frame, every
    fold reads it again. A fold's model learns from all rows of the other folds.
    """
    scored = None
    for fold in range(folds):
        fitted = fit(f"pli {fold}", make(), train.where(F.col("pli") != fold), features, label)
        part = fitted.predict(train.where(F.col("pli") == fold)).select("pli", label, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    per_fold = metrics(scored, ["pli"], label)
    return per_fold.agg(
        F.count(F.lit(1)).alias("plis"),
        F.avg("rmse").alias("rmse_moyen"),
        F.stddev_pop("rmse").alias("rmse_ecart_type"),
        F.min("rmse").alias("rmse_min"),
        F.max("rmse").alias("rmse_max"),
    )


def train_all(train: DataFrame, features: Sequence[str], forest: dict | None = None,
              boosting: dict | None = None, log_target: bool = False) -> tuple[list[Fitted], dict[str, float]]:
    """The four regressors, with the seconds each fit took; a skewed target is learnt as
    log(1 + y). Pass a stored or cached frame."""
    makers = {
        "Linear Regression": linear_regression(),
        "Ridge": ridge(train),
        "Random Forest": random_forest(**(forest or {})),
        "Gradient Boosting": boosted_trees(**(boosting or {})),
    }
    fitted, seconds = [], {}
    for name, learner in makers.items():
        begun = time.monotonic()
        fitted.append(fit(name, learner, train, features, log_target=log_target))
        seconds[name] = time.monotonic() - begun
    return fitted, seconds


# --- leakage --------------------------------------------------------------------------


@dataclass(frozen=True)
class SafeLots:
    """Training, validation and test rows, with the department figures they carry."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    stats: DepartmentStats


def safe_lots(df: DataFrame, parity: bool = False, keys: Sequence[str] = ()) -> SafeLots:
    """Lots whose department figures are learnt on the training rows only, within ``keys``.

    ``parity`` adds the price over the department mean, which knows the row's own price.
    Pass a stored frame with ``lot`` (see :func:`with_lot`).
    """
    parts = lots(without_department_figures(df))
    stats = training_stats(parts[0], keys)
    joined = [stats.apply(p) for p in parts]
    if parity:
        joined = [
            p.withColumn("ratio_prix_dept", F.try_divide(F.col(TARGET), F.col("dept_mean_price")))
            for p in joined
        ]
    return SafeLots(*joined, stats)


def without_department_figures(df: DataFrame) -> DataFrame:
    """Frame for the leakage check: no department figures, no price ratio."""
    return drop_prefixed(df, ("dept_",)).drop("ratio_prix_dept")


# --- projection -----------------------------------------------------------------------


# Columns that may not enter the projection model.
PROJECTION_EXCLUDED = [
    "ratio_prix_dept", "dept_valeur_fonciere_mean", "dept_valeur_fonciere_median",
    "dept_valeur_fonciere_std", "dept_valeur_fonciere_count", "dept_surface_reelle_bati_mean",
    "dept_surface_reelle_bati_median", "dept_densite_transactions", "dept_prix_x_surface",
]


def next_year_rows(df: DataFrame, year: int = 2025) -> DataFrame:
    """The rows moved to ``year``: only the date and ``annee`` change."""
    return df.withColumns(
        {"date_mutation": move_to_year(F.col("date_mutation"), year), "annee": F.lit(year)}
    )


def project(df: DataFrame, safe: SafeLots, year: int = 2025, learner=None,
            parity: bool = False) -> DataFrame:
    """Predicted price of every row moved to ``year``.

    The model learns on the training lot; the moved rows get the same department figures.
    Unless ``parity`` is set, the price per square metre is left out of the model too, as
    it knows the price.
    """
    known = safe.train.drop(*PROJECTION_EXCLUDED)
    if not parity:
        known = leak_free(known)
    features = default_features(known)
    fitted = fit("projection", learner or random_forest(), known.dropna(subset=features), features)
    rows = next_year_rows(without_department_figures(df), year)
    ready = safe.stats.apply(rows)
    gaps = [c for c in features if c in ready.columns]
    return fitted.predict(ready.fillna(0, subset=gaps), PREDICTION)


# --- predictions: summaries and comparison with observed prices ------------------------


def by_department(predictions: DataFrame) -> DataFrame:
    """Mean prediction per department, dearest first."""
    return (
        predictions.where(F.col("departement").isNotNull())
        .groupBy("departement")
        .agg(F.avg(PREDICTION).alias("prix_moyen"))
        .orderBy(F.desc("prix_moyen"), "departement")
    )


def by_month(predictions: DataFrame, departement: str | None = None) -> DataFrame:
    """Mean prediction per month and department, of one department or of all."""
    rows = predictions.where(F.col("departement").isNotNull())
    if departement:
        rows = rows.where(F.col("departement") == departement)
    return (
        rows.groupBy("mois", "departement")
        .agg(F.avg(PREDICTION).alias("prix_moyen"))
        .orderBy("mois", "departement")
    )


def dearest_and_cheapest(predictions: DataFrame, rows: int = 5) -> DataFrame:
    """First and last departments by mean prediction; codes padded to two digits."""
    means = predictions.where(F.col("departement").isNotNull()).groupBy(
        F.lpad("departement", 2, "0").alias("departement")
    ).agg(F.avg(PREDICTION).alias("prix_moyen"))
    top = means.orderBy(F.desc("prix_moyen"), "departement").limit(rows)
    low = means.orderBy("prix_moyen", "departement").limit(rows)
    return top.withColumn("liste", F.lit("plus chers")).unionByName(
        low.withColumn("liste", F.lit("moins chers"))
    )


def largest_departments(predictions: DataFrame, rows: int = 10) -> DataFrame:
    """Rows of the departments with the most predictions: a semi join on the top list."""
    top = (
        predictions.groupBy("departement")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("departement").isNotNull())
        .orderBy(F.desc("_n"), "departement")
        .limit(rows)
        .select("departement")
    )
    # The list has ``rows`` rows.
    return predictions.join(F.broadcast(top), "departement", "left_semi")


def stacked(observed: DataFrame, predicted: DataFrame) -> DataFrame:
    """Observed and predicted prices as one frame with a ``source``."""
    columns = ["code_postal", "surface_reelle_bati"]
    real = observed.select(F.lit("reel").alias("source"), *columns, F.col(TARGET).alias("prix"))
    guess = predicted.select(F.lit("predit").alias("source"), *columns, F.col(PREDICTION).alias("prix"))
    return real.unionByName(guess)


def observed_and_predicted(observed: DataFrame, predicted: DataFrame) -> DataFrame:
    """Rows, mean, median, deviation and mean surface of observed and predicted prices."""
    return group_summary(stacked(observed, predicted), "source", "prix")


def department_comparison(observed: DataFrame, predicted: DataFrame, rows: int = 10) -> DataFrame:
    """Observed and predicted mean price of the departments with the most observed sales."""
    real = (
        with_department(observed).where(F.col("departement").isNotNull())
        .groupBy("departement")
        .agg(F.count(F.lit(1)).alias("nb_reel"), F.avg(TARGET).alias("prix_reel"))
        .orderBy(F.desc("nb_reel"), "departement")
        .limit(rows)
    )
    guess = with_department(predicted).groupBy("departement").agg(
        F.count(F.lit(1)).alias("nb_predit"), F.avg(PREDICTION).alias("prix_predit")
    )
    return real.join(guess, "departement", "left").orderBy(F.desc("nb_reel"), "departement")


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Median and mean of all predictions."""
    figures = summarize(predictions, [], [PREDICTION])
    return spread(
        figures, [], {"mediane": (PREDICTION, F.col("p50")), "moyenne": (PREDICTION, F.col("mean"))}
    )
