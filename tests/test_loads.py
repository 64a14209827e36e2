"""Published months, the incremental cube, merged graphs, ranked paths."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelion.operators import cube, graph
from parcelion.schemas import SILVER
from parcelion.sources.published import MonthTable, Refused, key_rules


def _rows(spark, seed, months, n=60):
    rng = random.Random(seed)
    rows = [
        (date(2021 + m // 12, 1 + m % 12, rng.randrange(1, 28)), rng.choice(["Vente", "", "Échange"]), float(rng.choice([0, 1e5 / 3, 249000.12, rng.uniform(1, 9e5)])),
         "75001", rng.choice(["A", "B", "", None]), rng.choice(["Maison", "", None]), rng.choice([0.0, 33.3, None]), 1, "f", date(2025, 1, 1), f"{seed}-{m}-{i}")
        for m in months for i in range(rng.randrange(1, n))
    ]
    return spark.createDataFrame(rows, SILVER)


def _same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_loads_replace_their_window_and_empty_months(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), SILVER)
    assert table.read().count() == 0 and table.months() == {}
    first, second = _rows(spark, 1, range(12)), _rows(spark, 2, [3, 5, 14])
    table.load(first, 202101, 202112)
    held = table.months()
    table.load(second, 202104, 202106)
    window = F.month("date_mutation").between(4, 6) & (F.year("date_mutation") == 2021)
    _same(table.read(), first.where(~window).unionByName(second.where(window)))
    assert set(held) - set(table.months()) == {202105}
    _same(table.read(202104, 202106), second.where(window))
    old, new, months = table.changed(held)
    assert months == [202104, 202105, 202106]
    _same(old, first.where(window))
    _same(new, second.where(window))


def test_a_faulty_load_changes_nothing(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), SILVER)
    types = spark.createDataFrame([("Maison",), ("",)], "type_local string")
    rules = key_rules(["id_unique"], ["date_mutation"], {"type_local": types})
    good = _rows(spark, 1, [0, 1])
    table.load(good, 202101, 202102, rules)
    bad = good.unionByName(good.limit(3)).withColumn("type_local", F.lit("Autre"))
    with pytest.raises(Refused) as refused:
        table.load(bad, 202101, 202102, rules)
    assert refused.value.violations == {"id_unique unique": 3, "type_local exists": 1}
    _same(table.read(), good)
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("load-")]) == 1


def test_a_load_that_fails_midway_is_never_seen(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), SILVER)
    good = _rows(spark, 1, [0, 1])
    table.load(good, 202101, 202102)
    with pytest.raises(Exception, match="boom"):
        table.load(good.withColumn("commune", F.when(F.month("date_mutation") == 2, F.raise_error(F.lit("boom")).cast("string"))), 202101, 202102)
    _same(table.read(), good)
    # Two loads that began from the same list: the later one is told.
    with pytest.raises(RuntimeError, match="another load"):
        table._publish({}, 1)


def test_cube_equals_a_rebuild_after_every_change(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), SILVER)
    stored = None
    for seed, months, first, last in [(1, range(14), 202101, 202202), (2, [2, 3], 202103, 202105), (3, [], 202101, 202102), (4, [20], 202201, 202212)]:
        before = table.months()
        table.load(_rows(spark, seed, months), first, last)
        old, new, _ = table.changed(before)
        stored = cube.replaced(stored, old, new) if stored is not None else cube.cells(new)
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        _same(stored, cube.merged(cube.cells(table.read())))
    told = {(r.type_local, r.commune, r.annee): r for r in cube.figures(stored).collect()}
    plain = table.read().groupBy("type_local", "commune", F.year("date_mutation").alias("annee")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("valeur_fonciere").alias("v"), F.avg("surface_reelle_bati").alias("s")).collect()
    assert len(told) == len(plain)
    for row in plain:
        cell = told[row.type_local, row.commune, row.annee]
        assert cell.nb_ventes == row.n and abs(cell.total_valeur_fonciere - row.v) < 1e-2
        assert cell.surface_moyenne is None if row.s is None else abs(cell.surface_moyenne - row.s) < 1e-4


def test_a_second_load_adds_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "graph")
    rows = _rows(spark, 5, range(6)).cache()
    early = rows.where(F.month("date_mutation") <= 3)
    graph.merge_graph(spark, graph.build_graph(early), path)
    files = {p for p in (tmp_path / "graph").rglob("*.parquet")}
    told = {r.table: r for r in graph.merge_graph(spark, graph.build_graph(rows), path).collect()}
    assert files <= {p for p in (tmp_path / "graph").rglob("*.parquet")}
    stored, whole = graph.merged_graph(spark, path).tables(), graph.build_graph(rows).tables()
    for name in whole:
        _same(stored[name].select(*sorted(stored[name].columns)), whole[name].select(*sorted(whole[name].columns)))
        assert told[name].total == whole[name].count() and told[name].ignores == graph.build_graph(early).tables()[name].count()
    again = graph.merge_graph(spark, graph.build_graph(rows), path).collect()
    assert all(r.charges == 0 and r.ignores == r.total for r in again)


@pytest.mark.parametrize("filters", [{}, {"type_name": "Maison"}, {"nature": "Vente", "commune": "A"}, {"known_types_only": True}, {"commune": "Z"}])
def test_ranked_paths_equal_the_sorted_paths(spark, filters):
    found = graph.build_graph(_rows(spark, 7, range(8)))
    for rows in (1, 40, 5000):
        ranked = graph.ranked_paths(found, **filters, rows=rows).collect()
        assert ranked == graph.first_paths(graph.paths(found, **filters), rows).collect()


def test_no_route_multiplies_sales(spark):
    plan = graph.ranked_paths(graph.build_graph(_rows(spark, 7, range(3))))._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan or "row_number" in plan
    assert plan.index("_place") > 0 and plan.count("Join") == 2
