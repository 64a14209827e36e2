"""Segment preparation from end to end."""

import random
from datetime import date

from pyspark.sql import functions as F

from parcelion.operators import segments, silver
from parcelion.plans import analysis
from parcelion.session import stage_table

from .data import bronze, sale


def _segmented(spark):
    rnd = random.Random(11)
    rows = [
        sale(day=date(2021 + i % 3, 1 + i % 12, 1 + i % 28), price=float(rnd.randint(10_000, 2_000_000)),
             postal=rnd.choice(["1230", "75001", "69002", None]), commune=f"C{i % 7}",
             kind=rnd.choice(["Maison", "Appartement", "Local industriel. commercial", ""]),
             surface=float(rnd.randint(20, 180)), rooms=rnd.randint(0, 5))
        for i in range(900)
    ]
    base = silver.to_silver(bronze(spark, rows), 2021, 2024, date(2025, 1, 1))
    return stage_table(segments.clean_segments(stage_table(base)))


def test_prepared_segments_are_numeric_scaled_and_leak_free(spark):
    segmented = _segmented(spark)
    ready = analysis.prepare_all(segmented)
    for number, prepared in zip((1, 2, 3), ready):
        assert not {"prix_m2", "ratio_prix_dept", "valeur_fonciere", "date_mutation", "commune"} & set(prepared.columns)
        assert "annee" in prepared.columns and any(c.startswith("type_local_") for c in prepared.columns)
        kinds = dict(prepared.train.dtypes)
        assert all(kinds[c] in ("int", "bigint", "double") for c in prepared.columns)
        median = prepared.train.select(F.median("surface_reelle_bati")).first()[0]
        assert abs(median) < 1e-9
        whole = segmented.where(
            (F.col("segment") == number) & (F.col("nombre_pieces_principales") > 0) & F.col("code_postal").isNotNull())
        assert sum(lot.count() for lot in prepared.lots().values()) == whole.count()
    common, every = analysis.combined_lots(ready), analysis.combined_lots(ready, common_only=False)
    assert common["train"].count() == every["train"].count() == sum(p.train.count() for p in ready)
    assert set(common["train"].columns) <= set(every["train"].columns)
