"""What the stored layers and loads write and shuffle: each row's bytes once."""

import os
from datetime import date

from pyspark.sql import functions as F

from parcelion.functions.text import row_key
from parcelion.operators import graph, silver as silver_ops
from parcelion.plans import base, queries
from parcelion.schemas import DEDUP_KEY
from parcelion.session import shared_dir
from parcelion.sources import tables, testdata
from parcelion.sources.clustered import ClusteredSilver

from .data import bronze, sale


def _rows(df):
    return sorted(map(str, df.collect()))


def _silver(spark, n=40):
    rows = [sale(day=date(2021, 1 + i % 12, 3), price=float(i), commune=f"C{i % 5}", kind=None if i % 7 == 0 else "Maison") for i in range(n)]
    return silver_ops.to_silver(bronze(spark, rows), 2021, 2024, date(2025, 1, 1)).cache()


def _staged(spark):
    folder = f"{shared_dir(spark).removeprefix('file:')}/parcelion"
    return {name.rsplit("-", 1)[0] for name in os.listdir(folder)} if os.path.isdir(folder) else set()


def test_layers_are_stored_without_their_key(spark, sf):
    found, plain = base.stored_silver(spark, sf), base.silver(spark, sf)
    assert found.columns == plain.columns and _rows(found) == _rows(plain)
    for layer in (found, base.stored_segments(spark, sf), base.stored_engineered(spark, sf)):
        assert "id_unique" not in spark.read.parquet(*layer.inputFiles()).columns


def test_features_keep_the_keys_of_silver(spark, sf):
    """Also where features pad the postal code."""
    silver = base.stored_silver(spark, sf).select("id_unique")
    for layer in (base.stored_features(spark, sf), base.stored_engineered(spark, sf)):
        assert base._POSTAL not in layer.columns and layer.join(silver, "id_unique", "left_anti").isEmpty()


def test_lines_meet_orders_that_know_their_customer(spark, sf):
    plan = testdata.raw_mutations(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    # The join of orders and customers lies below that of the lines.
    order, line = plan.index("o_custkey"), plan.index("(l_orderkey")
    joins = [x.strip(" :+-") for x in plan.splitlines() if "Join Inner" in x]
    depth = {x: i for i, x in enumerate(plan.splitlines()) if "Join Inner" in x for x in [x.split("(")[1].split("#")[0]]}
    assert order and line and len(joins) == 4 and depth["o_custkey"] > depth["l_orderkey"]


def test_a_graph_load_stages_nothing(spark, tmp_path):
    found = graph.build_graph(_silver(spark))
    before = _staged(spark)
    told = graph.merge_graph(spark, found, str(tmp_path / "g")).collect()
    assert _staged(spark) == before and {r.table: r.charges for r in told}["nodes_mutation"] == 39
    assert all(r.charges == 0 for r in graph.merge_graph(spark, found, str(tmp_path / "g")).collect())


def test_a_clustered_build_stages_levels_only(spark, tmp_path):
    ClusteredSilver(spark, str(tmp_path / "c")).build(_silver(spark), 4)
    assert "placed" not in _staged(spark)


def test_derived_columns_are_computed_where_months_are_written(spark, tmp_path):
    rows = _silver(spark)
    for path, derived in (("plain", None), ("derived", {"id_unique": row_key(DEDUP_KEY)})):
        tables.replace_months(rows, str(tmp_path / path), derived)
    plain, found = (tables.read_months(spark, str(tmp_path / p), "2021-01-01", "2022-01-01") for p in ("plain", "derived"))
    assert found.columns == plain.columns and _rows(found) == _rows(plain) and found.count() == rows.count()


def test_fold_rows_and_labelled_rows_are_not_written(spark, sf):
    queries.fold_cross_validation(spark, sf)
    assert "folds" not in _staged(spark)


def test_months_are_stored_without_their_key(spark, sf, monkeypatch):
    written, replace = [], tables.replace_months
    monkeypatch.setattr(tables, "replace_months", lambda rows, path, derived=None: written.append((rows.columns, derived)) or replace(rows, path, derived))
    found = queries.silver_months(spark, sf)
    day = F.col("date_mutation")
    plain = base.stored_silver(spark, sf).where((day >= "1997-03-01") & (day < "1997-06-01"))
    assert found.columns == plain.columns and _rows(found) == _rows(plain) and found.count()
    assert len(written) == 2 and all("id_unique" not in columns and not derived for columns, derived in written)


def test_a_clustered_build_may_leave_out_the_key(spark, tmp_path):
    rows, plain = _silver(spark), ClusteredSilver(spark, str(tmp_path / "plain"))
    table = ClusteredSilver(spark, str(tmp_path / "c"), {"id_unique": row_key(DEDUP_KEY)})
    for built in (plain, table):
        built.build(rows, 4)
    assert "id_unique" not in spark.read.parquet(f"{table.path}/rows").columns
    assert _rows(table.read()) == _rows(rows) == _rows(plain.read()) and table.read().columns == rows.columns
    assert table.lookup(None, "c1").collect() == plain.lookup(None, "c1").collect() and _rows(table.names("c1")) == _rows(plain.names("c1"))


def test_graph_keys_of_any_text_survive_a_merge(spark, tmp_path):
    keys = ["ab" * 32, "AB" * 32, "abc", "xyz", "", "é", "01", None, "ab" * 32]
    rows = _silver(spark, len(keys)).drop("id_unique").toPandas()
    rows["type_local"], rows["valeur_fonciere"], rows["id_unique"] = "T", [float(i + 1) for i in range(len(rows))], [keys[i] for i in range(len(rows))]
    found = graph.build_graph(spark.createDataFrame(rows, _silver(spark).schema))
    path = str(tmp_path / "g")
    told = {r.table: (r.total, r.charges) for r in graph.merge_graph(spark, found, path).collect()}
    ids = [r.id for r in graph.merged_graph(spark, path).nodes_mutation.collect()]
    assert sorted(ids, key=str) == sorted(set(keys), key=str) and told["nodes_mutation"] == (9, 8)
    stored = spark.read.parquet(f"{path}/nodes_mutation").inputFiles()
    assert all(name.endswith(".zstd.parquet") or ".zstd." in name for name in stored)
    again = {r.table: r.charges for r in graph.merge_graph(spark, found, path).collect()}
    # A missing key meets no stored one.
    assert again["nodes_mutation"] == 1 and again["a_pour_type"] == 0


def test_sent_messages_are_compressed(spark, sf):
    folder = queries._sent(spark, sf)
    names = [n for n in os.listdir(folder.removeprefix("file:")) if n.startswith("part-")]
    assert names and all(n.endswith(".gz") for n in names)
    assert spark.read.text(folder).count() == testdata.mutations(spark, sf).count()
