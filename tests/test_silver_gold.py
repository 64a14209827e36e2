"""Duplicates, keys, star schema, graph and key figures."""

import hashlib
from datetime import date, datetime, timezone

from parcelion.operators import gold, graph, kpis, silver

from .data import bronze, sale


def _silver(spark, rows, **kw):
    return silver.to_silver(bronze(spark, rows), 2021, 2024, date(2025, 1, 1), **kw)


def test_window_is_half_open_and_drops_rows_without_a_date(spark):
    rows = [sale(day=d) for d in (date(2020, 12, 31), date(2021, 1, 1), date(2023, 12, 31), date(2024, 1, 1), None)]
    assert sorted(r.date_mutation for r in _silver(spark, rows).collect()) == [date(2021, 1, 1), date(2023, 12, 31)]
    assert tuple(silver.undated(bronze(spark, rows)).first()) == (5, 1)


def test_smallest_duplicate_is_kept_and_null_keys_are_equal(spark):
    rows = [sale(rooms=5), sale(rooms=2, surface=70.0), sale(rooms=3), sale(kind=None, rooms=1), sale(kind=None, rooms=9)]
    found = sorted((r.type_local or "", r.surface_reelle_bati, r.nombre_pieces_principales) for r in _silver(spark, rows).collect())
    assert found == [("", 50.0, 1), ("Maison", 50.0, 3)]


def test_key_hashes_the_double_and_skips_nulls(spark):
    rows = [sale(price=12_345_678.0), sale(price=10.5, kind=None)]
    keys = {r.valeur_fonciere: r.id_unique for r in _silver(spark, rows).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert keys[12_345_678.0] == sha("2021-05-01||75001||1.2345678E7||PARIS||Maison")
    assert keys[10.5] == sha("2021-05-01||75001||10.5||PARIS")


def test_other_store_types_give_the_same_silver(spark):
    df = bronze(spark, [sale(price=123456792.0), sale()])
    other = df.selectExpr("*").withColumns({
        "date_mutation": df.date_mutation.cast("timestamp"), "valeur_fonciere": df.valeur_fonciere.cast("string"),
        "nombre_pieces_principales": df.nombre_pieces_principales.cast("long")})
    one = silver.to_silver(df, 2021, 2024, date(2025, 1, 1))
    two = silver.to_silver(other, 2021, 2024, date(2025, 1, 1))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) and one.dtypes == two.dtypes


def test_hot_duplicates_are_combined_before_the_shuffle(spark):
    plan = silver.drop_duplicates(bronze(spark, [sale()]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_dimension_ids_are_dense_and_sorted(spark):
    rows = [sale(commune=f"C{i:03d}", postal=str(i)) for i in range(300)] + [sale(kind="")]
    star = gold.build_star(_silver(spark, rows))
    found = star.communes.orderBy("id_commune").collect()
    assert [r.id_commune for r in found] == list(range(1, 302))
    assert [r.nom_commune for r in found] == sorted(r.nom_commune for r in found)
    # Empty text is a name of its own.
    assert {r.type_local for r in star.types_locaux.collect()} == {"", "Maison"}
    assert all(r.violations == 0 for r in gold.integrity(star).collect())


def test_rows_without_a_name_join_nothing(spark):
    star = gold.build_star(_silver(spark, [sale(), sale(nature=None, price=5.0)]))
    assert star.transactions.count() == 1


def test_integrity_finds_orphans(spark):
    star = gold.build_star(_silver(spark, [sale(), sale(commune="LYON")]))
    broken = gold.Star(star.communes.where("nom_commune = 'LYON'"), star.types_locaux, star.natures_mutation, star.transactions)
    found = {r.regle: r.violations for r in gold.integrity(broken).collect()}
    assert found["transactions.id_commune exists"] == 1


def test_random_ids_are_optional(spark):
    base = _silver(spark, [sale()])
    dims = gold.communes(base), gold.types_locaux(base), gold.natures_mutation(base)
    ids = {gold.transactions(base, *dims, random_ids=True).first().id_transaction for _ in range(2)}
    assert len(ids) == 2


def test_cube_has_no_subtotals(spark):
    cube = gold.sales_cube(_silver(spark, [sale(), sale(price=1.0), sale(day=date(2022, 1, 1))]))
    assert sorted((r.annee, r.nb_ventes) for r in cube.collect()) == [(2021, 2), (2022, 1)]
    assert gold.cube_totals(cube, 2022).first().total_valeur_fonciere == 100_000.0


def test_paths_reach_all_sales_of_linked_communes(spark):
    rows = [sale(kind="Maison", price=1.0), sale(kind="Appartement", price=2.0), sale(kind="", price=3.0),
            sale(kind="Maison", price=0.0), sale(commune="", price=4.0), sale(nature="", commune="LYON", price=5.0)]
    built = graph.build_graph(_silver(spark, rows))
    assert built.nodes_mutation.count() == 4
    assert {r.nom for r in built.nodes_type.collect()} == {"Maison", "Appartement", "Inconnu"}
    assert {r.nom for r in built.nodes_nature.collect()} == {"Vente", "Inconnue"}
    # Maison is linked to PARIS (three sales) and LYON (one), by two natures.
    found = graph.paths(built, type_name="Maison")
    assert found.count() == 2 * 4
    counts = {(r.nature, r.type): r.chemins for r in graph.path_counts(built).collect()}
    assert counts[("Vente", "Maison")] == counts[("Inconnue", "Maison")] == 4
    known = graph.paths(built, nature="Vente", commune="PARIS", known_types_only=True)
    assert known.count() == 2 * 3


def test_graph_is_the_same_after_a_rerun_and_empty_after_a_wipe(spark, tmp_path):
    base = _silver(spark, [sale(), sale(price=7.0)])
    path = str(tmp_path / "g")
    for _ in range(2):
        graph.save_graph(graph.build_graph(base), path)
    assert graph.load_graph(spark, path).nodes_mutation.count() == 2
    graph.wipe_graph(spark, path)
    assert all(r.nombre == 0 for r in graph.node_counts(graph.load_graph(spark, path)).collect())


def test_key_figures(spark):
    rows = [sale(commune=c, price=p) for c, p in [("B", 1.0), ("B", 2.0), ("A", 3.0), ("A", 3.5), ("C", 4.0)]]
    found = kpis.key_values(bronze(spark, rows), datetime(2025, 1, 1, 12, tzinfo=timezone.utc), rows=2).collect()
    values = {(r.key, r.pos): r.value for r in found}
    assert values == {
        ("stat_total_documents", 0): "5", ("stat_moyenne_valeur_fonciere", 0): "2.7",
        ("last_update_stats", 0): "2025-01-01 13:00:00", ("top_communes", 0): "A (2)", ("top_communes", 1): "B (2)"}
    empty = {r.key: r.value for r in kpis.key_values(bronze(spark, []), datetime(2025, 7, 1, tzinfo=timezone.utc)).collect()}
    assert empty == {"stat_total_documents": "0", "stat_moyenne_valeur_fonciere": "0.0", "last_update_stats": "2025-07-01 02:00:00"}


def test_frequencies_leave_nulls_out(spark):
    df = bronze(spark, [sale(kind=None), sale(kind="X"), sale(kind="X"), sale(kind="")])
    assert [tuple(r) for r in kpis.frequencies(df, "type_local").collect()] == [("X", 2), ("", 1)]


def test_lookup_arguments(spark):
    df = _silver(spark, [sale(), sale(commune="LYON", postal="69001"), sale(commune="Saint-Lyon", postal="69002")])
    assert kpis.lookup(df).count() == 3
    assert kpis.lookup(df, "", "").count() == 3
    assert kpis.lookup(df, "69001", "lyon").count() == 1
    assert kpis.lookup(df, None, "lyon").count() == 2
    assert kpis.lookup(df, None, "l_on").count() == 2
    assert kpis.lookup(df, rows=1).count() == 1


def test_profile(spark):
    df = bronze(spark, [sale(kind=None), sale(), sale(), sale()])
    found = {r.colonne: (r.type, r.pct_nul) for r in kpis.profile(df).collect()}
    assert found["type_local"] == ("string", 25.0) and found["valeur_fonciere"] == ("double", 0.0)


def test_duplicates_are_sorted_by_price_before_texts(spark):
    plan = silver.drop_duplicates(bronze(spark, [sale()]))._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("\n") if "Sort [" in line]
    assert sorts and all(line.index("valeur_fonciere") < line.index("date_mutation") for line in sorts)
