"""Clustered silver: what filters read, and that they read enough."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelion.operators import kpis
from parcelion.schemas import SILVER
from parcelion.sources.clustered import ClusteredSilver, interleaved


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(9)
    names = ["Saint-Étienne", "SAINT-DENIS", "Paris 1", "Paris 12", "Lyon", "a_b%c", "İstanbul", "", None, "Aÿ"]
    rows = [
        (date(2021 + m // 12, 1 + m % 12, rng.randrange(1, 28)), "Vente", 1.0, f"{rng.randrange(1, 96):02d}{rng.randrange(3)}", rng.choice(names), "", 1.0, 1, "f", date(2025, 1, 1), f"{m}-{i}")
        for m in range(24) for i in range(150)
    ] + [(date(2021, 1, 1), "Vente", 1.0, None, "Paris 1", "", 1.0, 1, "f", date(2025, 1, 1), "none")]
    frame = spark.createDataFrame(rows, SILVER).cache()
    table = ClusteredSilver(spark, str(tmp_path_factory.mktemp("clustered")))
    table.build(frame, 64)
    return table, frame


def _same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_bits_take_turns(spark):
    found = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int").select("a", "b", interleaved(F.col("a"), F.col("b")).alias("z")).collect()
    for row in found:
        assert row.z == sum(((row.a >> i & 1) << 2 * i + 1) | ((row.b >> i & 1) << 2 * i) for i in range(3))


def test_filters_read_few_files_and_all_rows(stored):
    table, rows = stored
    everything = len(table.files())
    assert everything > 30
    code = F.col("code_postal") == "501"
    window = (F.col("date_mutation") >= "2021-04-01") & (F.col("date_mutation") < "2021-05-01")
    _same(table.read(), rows)
    _same(table.read(["501"]), rows.where(code))
    _same(table.read(None, "2021-04-01", "2021-05-01"), rows.where(window))
    _same(table.read(["501"], "2021-04-01", "2021-05-01"), rows.where(code & window))
    assert len(table.files(["501"])) <= everything / 3
    assert len(table.files(None, "2021-04-01", "2021-05-01")) <= everything / 3
    assert len(table.files(["501"], "2021-04-01", "2021-05-01")) <= everything / 16
    assert table.files([]) == [] and table.read(["zz"]).count() == 0


@pytest.mark.parametrize("text", ["saint-", "PARIS 1", "is%1", "_yon", "a_b%c", "é", "istan", "zzz", "%%%", "ÿ", "Saint-É"])
def test_names_and_rows_equal_a_scan(stored, text):
    table, rows = stored
    _same(table.names(text), rows.where(F.col("commune").ilike(f"%{text}%")).select("commune", "code_postal").distinct())
    for code in (None, "501"):
        assert table.lookup(code, text).collect() == kpis.lookup(rows, code, text).collect()


def test_rows_come_from_the_files_of_matching_names(stored, spark):
    table, rows = stored
    only = rows.where(F.col("commune") == "Lyon").select("code_postal").distinct().limit(1).first().code_postal
    read = {f.rsplit("/", 1)[-1] for f in table.lookup(only, "lyon").inputFiles()}
    assert read and len(read) <= len(table.files()) / 3
