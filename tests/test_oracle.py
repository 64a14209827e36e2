"""Registered queries against their SQL. All of them with PARCELION_FULL=1, otherwise
one or two per module; ``tests/check_oracle.py`` runs all at any scale factor."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from parcelion import schemas

from .harness import compare, connect

SOME = [
    "raw_scan", "message_json", "message_parsed", "bronze_rows", "silver_rows", "silver_months",
    "gold_transactions", "gold_stats_par_commune", "gold_integrity", "cube_ventes", "kpi_key_values",
    "profile_columns", "lookup_commune", "graph_nodes", "graph_path_type", "segment_cleaning",
    "segment_table", "dept_stats", "histogram_100", "box_segment_price", "ols_on_sample",
    "temporal_features", "geographic_features", "label_codes", "safe_validation", "baseline_metrics",
    "predictions_by_department", "stream_bronze", "stream_kpis",
]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(oracle_sql()) if os.environ.get("PARCELION_FULL") else SOME)
def test_query_equals_sql(spark, con, sf, name):
    assert compare(spark, con, sf, queries()[name], oracle_sql()[name]) == ""


def test_flagship(spark, sf):
    df = entry(spark)
    assert df.columns == ["nom_commune", "nb_transactions", "valeur_moyenne", "surface_totale"]
    assert df.limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_layers_have_their_schemas(spark, sf):
    for name, schema in [("bronze_rows", schemas.BRONZE), ("silver_rows", schemas.SILVER), ("gold_transactions", schemas.TRANSACTIONS)]:
        found = queries()[name](spark, sf).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_results_do_not_depend_on_the_session_zone(spark, con, sf):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("date_parts", "kpi_key_values", "silver_rows"):
            assert compare(spark, con, sf, queries()[name], oracle_sql()[name]) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
