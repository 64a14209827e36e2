"""Exact figures against numpy and pandas on awkward values."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelion.functions.numeric import with_ordered_bin
from parcelion.operators import distribution as d

QS = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


def _frame(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v double")


def _awkward():
    rnd = random.Random(7)
    rows = [("hot", 0.0)] * 700 + [("hot", rnd.uniform(-1e6, 1e6)) for _ in range(901)]
    rows += [("small", x) for x in (-3.5, -0.0, 0.0, 5e-324, 2.0**52, 1.9999999999999998, 2.0)]
    rows += [("one", 42.0), ("gap", None), ("gap", float("nan")), ("gap", 1.0), ("gap", 2.0), (None, 9.0)]
    return rows


def test_figures_match_pandas(spark):
    rows = _awkward()
    found = {r.k: r for r in d.summarize(_frame(spark, rows), ["k"], ["v"], QS).collect()}
    table = pd.DataFrame(rows, columns=["k", "v"]).dropna()
    assert set(found) == set(table.k)
    for key, group in table.groupby("k"):
        row, v = found[key], group.v
        assert row.n == len(v)
        assert math.isclose(row.mean, v.mean(), rel_tol=1e-9, abs_tol=1e-9)
        assert (row.min, row.max) == (v.min(), v.max())
        for q in QS:
            assert math.isclose(row[d.quantile_name(q)], np.quantile(v, q), rel_tol=1e-12, abs_tol=1e-300)
        if len(v) > 1:
            assert math.isclose(row.std, v.std(), rel_tol=1e-9)
            assert math.isclose(row.std_pop, v.std(ddof=0), rel_tol=1e-9)
            skew = ((v - v.mean()) ** 3).mean() / v.std(ddof=0) ** 3
            assert math.isclose(row.skew, skew, rel_tol=1e-7, abs_tol=1e-9)
        else:
            assert row.std is None


def test_several_columns_and_no_keys(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "a int, b double")
    found = {r.variable: (r.n, r.p50) for r in d.summarize(df, [], ["a", "b"]).collect()}
    assert found == {"a": (3, 2.0), "b": (2, 20.0)}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=2, max_size=60))
def test_bins_never_fall(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = sorted(with_ordered_bin(df, "v", "b").collect(), key=lambda r: r.v)
    bins = [r.b for r in rows]
    assert bins == sorted(bins)
    assert all(abs(r.edge) <= abs(r.v) and r.edge * r.v >= 0 for r in rows)


def test_bins_are_ordered_around_powers_of_two(spark):
    values = [s * math.nextafter(2.0**e, t) for e in range(-1000, 1000, 37) for t in (0.0, math.inf) for s in (1, -1)]
    values += [s * 2.0**e for e in range(-1000, 1000, 37) for s in (1, -1)] + [0.0, math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = sorted(with_ordered_bin(df, "v", "b").collect(), key=lambda r: r.v)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


@pytest.mark.parametrize("bins", [1, 7, 50, 100])
def test_histogram_matches_numpy(spark, bins):
    rnd = random.Random(bins)
    rows = [("a", rnd.choice([rnd.uniform(0, 1), round(rnd.uniform(0, 1), 1)])) for _ in range(500)]
    rows += [("flat", 3.0)] * 5 + [("tenths", i / 10) for i in range(11)]
    found = d.histogram(_frame(spark, rows), ["k"], "v", bins).collect()
    for key in ("a", "flat", "tenths"):
        values = [v for k, v in rows if k == key]
        want = {i: n for i, n in enumerate(np.histogram(values, bins=bins)[0]) if n}
        assert {r.classe: r.effectif for r in found if r.k == key} == want


def test_box_plot(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    row = d.box_plot(_frame(spark, [("a", v) for v in values]), ["k"], "v").first()
    q1, q3 = np.percentile(values, [25, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    assert (row.q1, row.q3, row.hors) == (q1, q3, 2)
    assert (row.moustache_basse, row.moustache_haute) == (min(inside), max(inside))


def test_exact_sample_has_exactly_n_rows_and_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.col("id").cast("string").alias("id"))
    first = d.exact_sample(df, ["k"], "id", 100)
    again = d.exact_sample(df.repartition(7), ["k"], "id", 100)
    assert {r.k: r["count"] for r in first.groupBy("k").count().collect()} == {"true": 100, "false": 100}
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
    assert d.exact_sample(df, [], "id", 9999).count() == 5000


def test_linear_fit(spark):
    rnd = random.Random(3)
    rows = [(x, 3 * x + 7 + rnd.gauss(0, 1)) for x in (rnd.uniform(0, 9) for _ in range(200))]
    df = spark.createDataFrame([("a", x, y) for x, y in rows], "k string, x double, y double")
    slope, intercept = np.polyfit(*zip(*rows), deg=1)
    row = d.linear_fit(df, ["k"], "x", "y").first()
    assert math.isclose(row.pente, slope, rel_tol=1e-9) and math.isclose(row.ordonnee, intercept, rel_tol=1e-9)
    assert math.isclose(row.y_max, slope * row.x_max + intercept, rel_tol=1e-9)


def test_near_equal_doubles_are_cut_until_a_task_can_order_them(spark, monkeypatch):
    rows = spark.range(60_000).select((F.lit(500_000.0) + F.col("id") * 7 % 60_000 / 20.0 + F.lit(1e-7)).alias("x"))
    rows = rows.union(spark.range(9_000).select(F.lit(500_001.5).alias("x")))
    exact = rows.agg(*[F.percentile("x", F.lit(q)) for q in (0.1, 0.5, 0.9)]).first()
    orders = []
    cut = d._cut_again

    def counted(*given):
        found = cut(*given)
        orders.append(found.agg(F.max("size")).first()[0])
        return found

    monkeypatch.setattr(d, "CELL_ROWS", 50)
    monkeypatch.setattr(d, "_cut_again", counted)
    found = d.summarize(rows, [], ["x"], (0.1, 0.5, 0.9)).first()
    assert (found.p10, found.p50, found.p90) == pytest.approx(tuple(exact), rel=1e-15)
    assert orders and orders[-1] <= 9_000
