"""Segments, department figures, features, encoding and scaling."""

import math
import random
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelion.operators import encode, explore, features
from parcelion.operators import segments as seg

from .data import bronze, sale


def test_a_price_on_a_bound_is_in_both_segments(spark):
    prices = [9_999.0, 10_000.0, 470_000.0, 1_300_000.0, 2_000_000.0, 2_000_001.0, None]
    df = seg.price_segments(seg.cut(bronze(spark, [sale(price=p) for p in prices])))
    found = sorted((r.valeur_fonciere, r.segment) for r in df.collect())
    assert found == [(10_000.0, 1), (470_000.0, 1), (470_000.0, 2), (1_300_000.0, 2), (1_300_000.0, 3), (2_000_000.0, 3)]
    assert [(r.seuil, r.nb) for r in seg.above(bronze(spark, [sale(price=p) for p in prices])).collect()] == [(5e8, 0), (2e6, 1)]


def test_surface_cleaning_matches_pandas_step_by_step(spark):
    rnd = random.Random(1)
    rows = [sale(price=rnd.uniform(5_000, 2_100_000), surface=rnd.choice([0.0, 0.0, rnd.uniform(1, 120), 900.0]), postal=str(i)) for i in range(400)]
    df = bronze(spark, rows)
    table = pd.DataFrame(rows, columns=df.columns)
    want = {}
    for number, low, high in seg.SEGMENTS:
        part = table[(table.valeur_fonciere >= low) & (table.valeur_fonciere <= high)]
        q1, q3 = part.surface_reelle_bati.quantile([0.25, 0.75])
        kept = part[part.surface_reelle_bati.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
        want[number] = (len(part), len(kept), (kept.surface_reelle_bati == 0).sum(), (kept.surface_reelle_bati != 0).sum())
    found = {r.segment: tuple(r)[1:] for r in seg.cleaning_counts(df).collect()}
    assert found == want
    sizes = {r.segment: r["count"] for r in seg.clean_segments(df).groupBy("segment").count().collect()}
    assert sizes == {s: w[3] for s, w in want.items()}


def _segmented(spark):
    rnd = random.Random(2)
    rows = []
    for s in (1, 2, 3):
        for i in range(60):
            postal = rnd.choice(["1230", "75001", "69002", "13005"] if s < 3 else ["1230", "75001"])
            rows.append((*sale(price=float(rnd.randint(1, 10**6)), postal=postal, surface=float(rnd.randint(1, 200))), s))
    return spark.createDataFrame(rows, "date_mutation date, nature_mutation string, valeur_fonciere double, code_postal string, commune string, type_local string, surface_reelle_bati double, nombre_pieces_principales int, fichier_source string, segment int"), rows


def test_department_figures_match_pandas(spark):
    df, rows = _segmented(spark)
    table = pd.DataFrame(rows, columns=df.columns)
    table["departement"] = table.code_postal.str.zfill(5).str[:2]
    stats = explore.department_stats(df)
    for r in stats.collect():
        part = table[(table.segment == r.segment) & (table.departement == r.departement)]
        v, s = part.valeur_fonciere, part.surface_reelle_bati
        assert r.valeur_fonciere_count == len(part)
        assert r.valeur_fonciere_mean == np.rint(v.mean()) and r.valeur_fonciere_median == np.rint(v.median())
        assert r.valeur_fonciere_std == np.rint(v.std()) and r.surface_reelle_bati_median == np.rint(s.median())
    assert [r.departement for r in explore.common_departments(df).collect()] == ["01", "75"]
    assert [r.departement for r in explore.common_department_prices(stats).collect()] == ["01", "75"]
    ends = {r.segment: r for r in explore.extremes(stats).collect()}
    means = {(r.segment, r.departement): r.valeur_fonciere_mean for r in stats.collect()}
    for s in (1, 2, 3):
        own = {d: m for (t, d), m in means.items() if t == s}
        assert ends[s].prix_plus_cher == max(own.values()) == own[ends[s].plus_cher]
        assert ends[s].prix_moins_cher == min(own.values()) == own[ends[s].moins_cher]


def test_null_keys_are_left_out_of_department_figures(spark):
    df, _ = _segmented(spark)
    extra = df.limit(1).withColumn("code_postal", F.lit(None).cast("string"))
    assert explore.department_stats(df.unionByName(extra)).where("departement IS NULL").count() == 0


@pytest.mark.parametrize("surface, name", [
    (0.5, "Très petit"), (50.0, "Très petit"), (50.1, "Petit"), (100.0, "Petit"), (150.0, "Moyen"),
    (200.0, "Grand"), (200.5, "Très grand"), (0.0, None), (None, None)])
def test_surface_classes_are_closed_on_the_right(spark, surface, name):
    df = spark.createDataFrame([(surface,)], "s double")
    assert df.select(features.surface_class(F.col("s"))).first()[0] == name


def test_features_match_pandas(spark):
    rows = [(*sale(day=date(2021, 1 + i % 12, 1 + i % 28), price=100_000.0 + 777 * i, surface=20.0 + 9 * (i % 25), rooms=i % 5, postal=["1230", "75001"][i % 2]), f"id{i}") for i in range(80)]
    df = spark.createDataFrame(rows, "date_mutation date, nature_mutation string, valeur_fonciere double, code_postal string, commune string, type_local string, surface_reelle_bati double, nombre_pieces_principales int, fichier_source string, id_unique string")
    found = {r.id_unique: r for r in features.engineered(df).collect()}
    t = pd.DataFrame(rows, columns=df.columns)
    t["d"] = pd.to_datetime(t.date_mutation)
    first = t.d.min()
    t = t[(t.surface_reelle_bati > 0) & (t.nombre_pieces_principales > 0)].copy()
    t["departement"] = t.code_postal.str.zfill(5).str[:2]
    means = t.groupby("departement").valeur_fonciere.mean().round(2)
    assert len(found) == len(t)
    for r in t.itertuples():
        f = found[r.id_unique]
        assert (f.annee, f.mois, f.trimestre, f.jour_semaine, f.jour_annee) == (r.d.year, r.d.month, r.d.quarter, r.d.dayofweek, r.d.dayofyear)
        assert f.jours_depuis_debut == (r.d - first).days
        assert math.isclose(f.mois_sin, math.sin(2 * math.pi * r.d.month / 12), abs_tol=1e-12)
        assert f.prix_m2 == r.valeur_fonciere / r.surface_reelle_bati
        assert f.dept_valeur_fonciere_mean == means[r.departement]
        assert math.isclose(f.ratio_prix_dept, r.valeur_fonciere / means[r.departement])
        assert f.type_local_x_surface_cat == f"Maison_{f.categorie_surface}"
    assert not set(features.leak_free(features.engineered(df)).columns) & set(features.TARGET_DERIVED)


def test_one_hot_for_few_levels_and_sorted_codes_for_many(spark):
    rows = [("a", f"v{i:02d}") for i in range(12)] + [("b", "v00"), (None, None)]
    df = spark.createDataFrame(rows, "few string, many string")
    out = encode.CategoricalEncoder.fit(df, ["few", "many"]).transform(df)
    assert set(out.columns) == {"few_a", "few_b", "few_nan", "many_encoded"}
    found = out.collect()
    assert sum(r.few_a for r in found) == 12 and sum(r.few_nan for r in found) == 1
    # The text of a missing value sorts before the others here.
    want = {v: i for i, v in enumerate(sorted({v or "nan" for _, v in rows}))}
    assert sorted(r.many_encoded for r in found) == sorted(want[v or "nan"] for _, v in rows)


def test_level_names_with_a_dot_can_be_read(spark):
    df = spark.createDataFrame([("Local industriel. commercial", 1), ("Maison", 2)], "kind string, i int")
    out = encode.CategoricalEncoder.fit(df, ["kind"]).transform(df)
    assert [tuple(r) for r in out.orderBy("i").select("kind_Local industriel_ commercial", "kind_Maison").collect()] == [(1, 0), (0, 1)]


def test_scalers_match_numpy_and_survive_constants(spark):
    values = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([(v, 3.0) for v in values], "x double, c double")
    q1, q2, q3 = np.percentile(values, [25, 50, 75])
    robust = [tuple(r) for r in encode.robust_scaler(df, ["x", "c"]).transform(df).collect()]
    assert np.allclose(robust, [((v - q2) / (q3 - q1), 0.0) for v in values])
    standard = [tuple(r) for r in encode.standard_scaler(df, ["x", "c"]).transform(df).collect()]
    assert np.allclose(standard, [((v - np.mean(values)) / np.std(values), 0.0) for v in values])


def test_gaps_infinities_and_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2), (float("inf"), 3), (3.0, 4), (float("nan"), 5)], "x double, i int")
    filled = sorted((r.i, r.x) for r in features.impute_median(df, ["x", "i"]).collect())
    assert filled == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0), (5, 2.0)]
    assert sorted(r.i for r in features.complete_rows(df, ["x", "i"]).collect()) == [1, 4]


def test_columns_by_type_prefix_and_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, "7", "x", date(2020, 3, 4))], "a int, dept_b double, t string, u string, d date")
    assert features.numeric_columns(df) == ["a", "dept_b"] and features.text_columns(df) == ["t", "u"]
    assert features.drop_prefixed(df, ("dept_",)).columns == ["a", "t", "u", "d"]
    assert tuple(features.as_numbers(df, ["t", "u"]).select("t", "u").first()) == (7.0, 0.0)
    assert tuple(features.align(df, ["zz", "a"]).first()) == (0, 1)
    parts = features.split_dates(df, ["d"]).first()
    assert (parts.d_year, parts.d_month, parts.d_day, parts.d_dayofweek, parts.d_quarter, parts.d_timestamp) == (2020, 3, 4, 2, 1, 1583280000)
    texts = spark.createDataFrame([(None, "x"), ("2020-01-01", "y")], "p string, q string")
    assert features.date_like(texts, ["p", "q"]) == ["p"]


def test_a_few_dashes_do_not_hide_a_column_of_dates(spark):
    rows = [("-", "-", None)] * 10 + [(f"2020-01-{1 + i % 28:02d}", f"2020-01-{1 + i % 28:02d}" if i % 2 else "x", None) for i in range(100)]
    df = spark.createDataFrame(rows, "p string, half string, none string")
    assert features.date_like(df, ["p", "half", "none"]) == ["p"] and features.date_like(df, []) == []
    parts = features.dates_found(df, ["p", "half"])
    assert "p_year" in parts.columns and "half" in parts.columns and parts.where("p_year IS NULL").count() == 10


def test_groups_are_encoded_and_scaled_on_their_own(spark):
    rows = [("a", "x", 1.0), ("a", "y", 2.0), ("a", None, 4.0), ("b", "z", 10.0), ("b", "z", 10.0)]
    df = spark.createDataFrame(rows, "g string, kind string, v double")
    flags = encode.encoded_by(df, "g", ["a", "b"], ["kind"])
    found = sorted((r.g, r.v, r.kind_x, r.kind_y, r.kind_z, r.kind_nan) for r in flags.collect())
    assert found == [("a", 1.0, 1, 0, 0, 0), ("a", 2.0, 0, 1, 0, 0), ("a", 4.0, 0, 0, 0, 1), ("b", 10.0, 0, 0, 1, 0), ("b", 10.0, 0, 0, 1, 0)]
    codes = encode.encoded_by(df, "g", ["a", "b"], ["kind"], one_hot=0)
    assert sorted((r.g, r.v, r.kind_encoded) for r in codes.collect()) == [("a", 1.0, 1), ("a", 2.0, 2), ("a", 4.0, 0), ("b", 10.0, 0), ("b", 10.0, 0)]
    robust = encode.scaled_by(df, df.where("kind IS NOT NULL"), "g", ["v"])
    assert sorted((r.g, r.v) for r in robust.collect()) == [("a", -1.0), ("a", 1.0), ("a", 5.0), ("b", 0.0), ("b", 0.0)]
    plain = encode.scaled_by(df, df.where("g = 'a' AND kind IS NOT NULL"), "g", ["v"], robust=False)
    assert sorted(((r.g, r.v) for r in plain.collect()), key=str) == [("a", -1.0), ("a", 1.0), ("a", 5.0), ("b", None), ("b", None)]
