"""Registered queries: one function per operator, over (spark, test-data folder)."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date, datetime, timezone

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelion.functions.dates import move_to_year
from parcelion.functions.numeric import half_even
from parcelion.functions.text import row_key
from parcelion.operators import (
    boosting, clean, distribution, explore, features, foldstats, gold, gram, graph, kpis, models, neighbours,
)
from parcelion.operators import cube as cubes
from parcelion.operators import segments as seg
from parcelion.operators import silver as silver_ops
from parcelion.operators.encode import encoded_by, scaled_by, standard_scaler
from parcelion.plans import analysis
from parcelion.plans.base import (
    YEAR_FROM, YEAR_TO, bronze, second_segment, silver, stored, stored_all_features, stored_engineered, stored_features, stored_segments,
    stored_silver, window_silver,
)
from parcelion.schemas import DEDUP_KEY, SILVER
from parcelion.session import fresh_path, stage_table
from parcelion.sources import messages, raw, tables, testdata
from parcelion.sources.clustered import ClusteredSilver
from parcelion.sources.published import MonthTable, Refused, key_rules
from parcelion.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A commune that occurs at every scale factor, and the year the roll-up asks for.
COMMUNE, POSTAL_CODE, CUBE_YEAR = "NATION_1-4", "1013", 1997
PROJECTION_YEAR = 2003
_PRICE, _SURFACE = "valeur_fonciere", "surface_reelle_bati"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and messages ---------------------------------------------------------------


@query
def raw_scan(spark, sf):
    """Raw text written, scanned as 43 text columns and projected."""
    path = fresh_path(spark, "raw")
    raw.write_raw(testdata.raw_mutations(spark, sf), path)
    return raw.message_fields(raw.scan_raw(spark, path)).drop("fichier_source")


@query
def raw_scan_chosen(spark, sf):
    """Two of the yearly folders, as one scan."""
    path = fresh_path(spark, "raw")
    rows = testdata.raw_mutations(spark, sf)
    raw.write_raw(rows, path, folder_by="fichier_source")
    chosen = [f"{path}/fichier_source=mutations-{y}" for y in (1996, 1998)]
    return (
        raw.message_fields(raw.scan_raw(spark, chosen))
        .groupBy("nature_mutation", "type_local")
        .agg(F.count(F.lit(1)).alias("lignes"), F.count("valeur_fonciere").alias("avec_valeur"))
    )


@query
def message_rows(spark, sf):
    return testdata.mutations(spark, sf)


@query
def message_json(spark, sf):
    return messages.to_messages(testdata.mutations(spark, sf))


@query
def message_parsed(spark, sf):
    """Messages as bytes, parsed back to text fields."""
    sent = messages.to_messages(testdata.mutations(spark, sf))
    return messages.parse_messages(sent.select(F.col("value").cast("binary").alias("value")))


@query
def message_quarantine(spark, sf):
    """Good and corrupt payloads counted, with one broken message per blank type."""
    rows = testdata.mutations(spark, sf)
    sent = messages.to_messages(rows).select(
        F.when(F.get_json_object("value", "$.type_local") == "", F.substring("value", 1, 20))
        .otherwise(F.col("value")).alias("value")
    )
    good, bad = messages.split_corrupt(stage_table(sent, "messages"))
    return good.agg(F.count(F.lit(1)).alias("nb")).select(F.lit("lus").alias("etat"), "nb").unionByName(
        bad.agg(F.count(F.lit(1)).alias("nb")).select(F.lit("rejetes").alias("etat"), "nb")
    )


@query
def source_counts(spark, sf):
    return raw.source_counts(testdata.mutations(spark, sf))


# --- bronze and silver ------------------------------------------------------------------


@query
def bronze_rows(spark, sf):
    return bronze(spark, sf)


@query
def bronze_undated(spark, sf):
    return silver_ops.undated(bronze(spark, sf))


@query
def bronze_appended(spark, sf):
    """Two appends to one stored table hold both."""
    path = fresh_path(spark, "bronze")
    rows = stage_table(bronze(spark, sf), "bronze")
    tables.write_table(rows, path)
    tables.write_table(rows, path)
    return tables.read_table(spark, path, schema=rows.schema).groupBy("fichier_source").agg(
        F.count(F.lit(1)).alias("lignes")
    )


@query
def defaults_filled(spark, sf):
    rows = clean.fill_defaults(clean.typed(testdata.mutations(spark, sf)))
    return rows.select(
        "date_mutation", "commune", F.col(_PRICE).cast("double").alias(_PRICE),
        F.col(_SURFACE).cast("double").alias(_SURFACE), "nombre_pieces_principales",
    )


@query
def dates_repaired(spark, sf):
    """Counts of changed and ignored dates where blank-type rows carry ISO text."""
    text = F.when(
        F.col("type_local") == "",
        F.concat_ws("-", F.substring("date_mutation", 7, 4), F.substring("date_mutation", 4, 2),
                    F.substring("date_mutation", 1, 2)),
    ).otherwise(F.col("date_mutation"))
    rows = testdata.mutations(spark, sf).withColumn("date_mutation", text)
    return clean.repair_counts(clean.repair_dates(rows))


@query
def silver_rows(spark, sf):
    """Silver of a date window."""
    return window_silver(spark, sf)


@query
def silver_duplicates(spark, sf):
    """Rows and kept rows per year."""
    rows = silver_ops.date_window(bronze(spark, sf), date(1996, 1, 1), date(1999, 1, 1))
    return silver_ops.duplicate_counts(rows)


@query
def silver_months(spark, sf):
    """Silver stored by month, twice over, and read back for a quarter."""
    path = fresh_path(spark, "silver")
    # The key is a digest of stored columns, and most of a row's bytes: it is computed where it is read.
    rows = stored_silver(spark, sf).drop("id_unique")
    tables.replace_months(rows, path)
    tables.replace_months(rows, path)
    read = tables.read_months(spark, path, "1997-03-01", "1997-06-01").withColumn("id_unique", row_key(DEDUP_KEY))
    return read.select(*SILVER.fieldNames())


@query
def silver_preview(spark, sf):
    """First rows of the stored table."""
    return tables.overview(stored_silver(spark, sf).orderBy("id_unique"))[2]


@query
def silver_csv(spark, sf):
    """Silver through a CSV export."""
    path = fresh_path(spark, "csv")
    tables.export_csv(silver(spark, sf), path)
    return tables.import_csv(spark, path, SILVER).fillna("", subset=["type_local"])


@query
def parquet_sample(spark, sf):
    """A tenth of silver by digest, 20,000 rows at most, as a stored table, and its report."""
    path = fresh_path(spark, "sample")
    tables.export_sample(stored_silver(spark, sf), path, identity="id_unique")
    return _rounded(kpis.parquet_report(tables.read_table(spark, path)), ["valeur_moyenne"])


# --- gold -------------------------------------------------------------------------------


def _star(spark, sf) -> gold.Star:
    return gold.build_star(stored_silver(spark, sf))


@query
def dim_communes(spark, sf):
    return gold.communes(silver(spark, sf))


@query
def dim_types(spark, sf):
    return gold.types_locaux(silver(spark, sf))


@query
def dim_natures(spark, sf):
    return gold.natures_mutation(silver(spark, sf))


@query
def gold_transactions(spark, sf):
    return _star(spark, sf).transactions


@query
def gold_detail(spark, sf):
    return gold.detailed(_star(spark, sf))


@query
def gold_stats_par_commune(spark, sf):
    return gold.stats_by_commune(_star(spark, sf))


@query
def gold_stats_par_type(spark, sf):
    return gold.stats_by_type(_star(spark, sf))


@query
def gold_view(spark, sf):
    """SQL over the registered view."""
    gold.register_views(_star(spark, sf))
    return spark.sql(
        "SELECT type_local, nature_mutation, count(*) AS nb, sum(valeur_fonciere) AS total "
        "FROM dl_gold_transactions_detaillees GROUP BY type_local, nature_mutation"
    )


@query
def gold_integrity(spark, sf):
    star = _star(spark, sf)
    return gold.integrity(
        gold.Star(star.communes, star.types_locaux, star.natures_mutation,
                  stage_table(star.transactions, "fact"))
    )


@query
def cube_ventes(spark, sf):
    return gold.sales_cube(silver(spark, sf))


@query
def cube_par_commune_annee(spark, sf):
    """Roll-up over the stored cube."""
    return gold.cube_totals(stage_table(gold.sales_cube(silver(spark, sf)), "cube"), CUBE_YEAR)


def _published(spark, sf) -> tuple[MonthTable, dict[int, str], dict[int, str]]:
    """Silver published for 1996 to 1998, then loaded again for 1997 with June emptied, cheap sales of July gone and late sales of December
    1998 moved in from 1997: the table and its months before and after."""
    table = MonthTable(spark, fresh_path(spark, "published"), SILVER)
    rows, rules = stored_silver(spark, sf), key_rules(["id_unique"], ["date_mutation", "commune"])
    before = table.load(rows, 199601, 199812, rules)
    month = F.month("date_mutation")
    late = rows.where((month != 6) & ((month != 7) | (F.col(_PRICE) > 500_000)))
    after = table.load(late, 199701, 199712, rules)
    return table, before, after


@query
def silver_published(spark, sf):
    """The published months after a load that empties one and thins out another."""
    return _published(spark, sf)[0].read().select(*SILVER.fieldNames())


@query
def cube_incremental(spark, sf):
    """The cube of the first load, brought up to date by the months that the second load changed."""
    table, before, _ = _published(spark, sf)
    old, new, _ = table.changed(before)
    kept = [m for m in before if not 199701 <= m <= 199712]
    stored_rows = old.unionByName(table.read(min(kept), 199612)).unionByName(table.read(199801, max(kept)))
    cube = stage_table(cubes.cells(stored_rows), "cube")
    return _rounded(cubes.figures(cubes.replaced(cube, old, new)), ["total_valeur_fonciere", "surface_moyenne"])


@query
def load_refused(spark, sf):
    """What a load with planted faults breaks: double keys, missing communes, types that the dimension does not have."""
    table = MonthTable(spark, fresh_path(spark, "refused"), SILVER)
    rows = stored_silver(spark, sf)
    cheap = F.col(_PRICE) < 100_000
    faulty = rows.withColumns({
        "commune": F.when(cheap & (F.month("date_mutation") == 1), None).otherwise(F.col("commune")),
        "type_local": F.when(cheap & (F.month("date_mutation") == 2), F.concat(F.lit("?"), "type_local")).otherwise(F.col("type_local")),
    }).unionByName(rows.where(cheap & (F.month("date_mutation") == 3)))
    rules = key_rules(["id_unique"], ["date_mutation", "commune"], {"type_local": gold.types_locaux(rows)})
    found = {}
    try:
        table.load(faulty, 100 * YEAR_FROM, 100 * YEAR_TO, rules)
    except Refused as refused:
        found = refused.violations
    months = len(table.months())
    return spark.createDataFrame([(rule, n, months) for rule, n in found.items()], "regle string, violations long, mois_publies long")


@query
def silver_schema(spark, sf):
    """Rows and columns of the stored table: name, type and place."""
    count, schema, _ = tables.overview(stored_silver(spark, sf))
    rows = [(i, f.name, f.dataType.simpleString(), count) for i, f in enumerate(schema.fields, 1)]
    return spark.createDataFrame(rows, "place int, colonne string, genre string, lignes long")


@query
def silver_empty_window(spark, sf):
    """A window without rows gives silver without rows, which is told and not stored."""
    rows = silver_ops.to_silver(bronze(spark, sf), 1900, 1901, date(2025, 1, 1))
    return rows.agg(F.count(F.lit(1)).alias("lignes"), F.count_distinct("id_unique").alias("cles"))


# --- key figures, profile, lookup -------------------------------------------------------


@query
def kpi_headline(spark, sf):
    return kpis.headline(bronze(spark, sf))


@query
def kpi_top5(spark, sf):
    return kpis.top_communes(bronze(spark, sf))


@query
def kpi_key_values(spark, sf):
    rows = bronze(spark, sf).select("commune", _PRICE)
    return kpis.key_values(rows, now=datetime(2025, 7, 1, 10, tzinfo=timezone.utc))


@query
def kpi_list(spark, sf):
    """The stored list of communes, read back and split."""
    path = fresh_path(spark, "kpis")
    kpis.save_key_values(kpis.key_values(bronze(spark, sf).select("commune", _PRICE)), path)
    return kpis.read_list(tables.read_table(spark, path), "top_communes")


@query
def kpi_report(spark, sf):
    return kpis.parquet_report(bronze(spark, sf))


@query
def profile_columns(spark, sf):
    """Missing values per column before defaults are filled in."""
    return kpis.profile(clean.typed(testdata.mutations(spark, sf)))


@query
def profile_shape(spark, sf):
    """Rows and columns of the typed table."""
    rows = clean.typed(testdata.mutations(spark, sf))
    return rows.agg(F.count(F.lit(1)).alias("lignes")).withColumn("colonnes", F.lit(len(rows.columns)).cast("long"))


@query
def profile_head(spark, sf):
    """The first 100 rows in a total order."""
    return tables.overview(stored_silver(spark, sf).orderBy("date_mutation", "id_unique"), 100)[2]


@query
def frequent_communes(spark, sf):
    return kpis.frequencies(silver(spark, sf), "commune", 10)


@query
def frequent_types(spark, sf):
    return kpis.frequencies(silver(spark, sf), "type_local")


@query
def frequent_natures(spark, sf):
    return kpis.frequencies(silver(spark, sf), "nature_mutation")


@query
def lookup_postal_code(spark, sf):
    return kpis.lookup(silver(spark, sf), postal_code=POSTAL_CODE)


@query
def lookup_commune(spark, sf):
    return kpis.lookup(silver(spark, sf), postal_code="", commune="ation_1")


def _clustered(spark, sf) -> ClusteredSilver:
    """Silver clustered by month and postal code, built once per application and folder, its content key computed when read."""
    key = {"id_unique": row_key(DEDUP_KEY)}

    def build():
        path = fresh_path(spark, "clustered")
        ClusteredSilver(spark, path, key).build(stored_silver(spark, sf), files=32)
        return spark.createDataFrame([(path,)], "path string")

    return ClusteredSilver(spark, stored(spark, sf, "clustered", build).first().path, key)


@query
def lookup_clustered(spark, sf):
    """One postal code in a quarter, from the files whose spans hold both."""
    return _clustered(spark, sf).read([POSTAL_CODE], "1997-01-01", "1997-04-01")


@query
def lookup_indexed(spark, sf):
    """Rows of communes that contain a text, by way of the name index."""
    return _clustered(spark, sf).lookup(commune="ATION_1%-3")


@query
def names_indexed(spark, sf):
    """Names and postal codes that contain a text with a wildcard."""
    return _clustered(spark, sf).names("tion_2_-")


# --- graph ------------------------------------------------------------------------------


def _graph(spark, sf) -> graph.Graph:
    return graph.build_graph(stored_silver(spark, sf))


@query
def graph_nodes(spark, sf):
    return graph.node_counts(_graph(spark, sf))


@query
def graph_edges_type(spark, sf):
    return _graph(spark, sf).a_pour_type


@query
def graph_edges_lieu(spark, sf):
    return _graph(spark, sf).a_pour_lieu


@query
def graph_mutations(spark, sf):
    return _graph(spark, sf).nodes_mutation


@query
def graph_path_type(spark, sf):
    return graph.ranked_paths(_graph(spark, sf), type_name="ECONOMY")


@query
def graph_path_counts(spark, sf):
    return graph.path_counts(_graph(spark, sf))


@query
def graph_path_nature_commune(spark, sf):
    return graph.ranked_paths(_graph(spark, sf), nature="1-URGENT", commune=COMMUNE, known_types_only=True)


@query
def graph_sales_by_commune(spark, sf):
    return graph.communes_by_sales(_graph(spark, sf))


@query
def graph_commune_history(spark, sf):
    return graph.commune_history(_graph(spark, sf), COMMUNE)


@query
def graph_list_nodes(spark, sf):
    return graph.list_nodes(_graph(spark, sf))


@query
def graph_reloaded(spark, sf):
    """The graph stored and read back."""
    path = fresh_path(spark, "graph")
    graph.save_graph(_graph(spark, sf), path)
    return graph.node_counts(graph.load_graph(spark, path))


def _merged_twice(spark, sf) -> tuple[str, DataFrame]:
    """A graph of the sales until 1996, then all sales merged into it: folder and counters of both loads."""
    path = fresh_path(spark, "graph")
    rows = stored_silver(spark, sf)
    early = graph.merge_graph(spark, graph.build_graph(rows.where(F.year("date_mutation") <= 1996)), path)
    late = graph.merge_graph(spark, graph.build_graph(rows), path)
    return path, early.withColumn("chargement", F.lit(1)).unionByName(late.withColumn("chargement", F.lit(2)))


@query
def graph_merged(spark, sf):
    """The graph after overlapping loads."""
    path, _ = _merged_twice(spark, sf)
    return graph.node_counts(graph.merged_graph(spark, path))


@query
def graph_load_counters(spark, sf):
    """Nodes and edges of each load: all, added, known already."""
    return _merged_twice(spark, sf)[1]


@query
def graph_wiped(spark, sf):
    """The stored graph after all nodes and edges were deleted."""
    path = fresh_path(spark, "graph")
    graph.save_graph(_graph(spark, sf), path)
    graph.wipe_graph(spark, path)
    return graph.node_counts(graph.load_graph(spark, path))


# --- exploration ------------------------------------------------------------------------


@query
def outliers_above(spark, sf):
    return seg.above(silver(spark, sf))


@query
def segment_counts(spark, sf):
    return (
        seg.price_segments(seg.cut(silver(spark, sf)))
        .groupBy("segment").agg(F.count(F.lit(1)).alias("lignes"))
    )


@query
def segment_iqr_bounds(spark, sf):
    return seg.iqr_bounds(seg.price_segments(seg.cut(stored_silver(spark, sf))))


@query
def segment_cleaning(spark, sf):
    return seg.cleaning_counts(stored_silver(spark, sf))


@query
def segment_rows(spark, sf):
    return seg.clean_segments(stored_silver(spark, sf)).select("id_unique", "segment", _SURFACE)


def _rounded(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    return df.withColumns({c: half_even(F.col(c), digits) for c in columns})


@query
def segment_summary(spark, sf):
    return _rounded(explore.group_summary(stored_segments(spark, sf), "segment"), ["ecart_type"])


@query
def segment_table(spark, sf):
    summary = explore.group_summary(stored_segments(spark, sf), "segment")
    return explore.comparison_table(summary, "segment", {s: f"segment_{s}" for s in (1, 2, 3)})


@query
def segment_price_m2(spark, sf):
    return _rounded(explore.price_per_m2(stored_segments(spark, sf)), ["prix_m2_moyen"], 4)


@query
def yearly_mean(spark, sf):
    return explore.mean_by(stored_segments(spark, sf), "annee")


@query
def monthly_mean(spark, sf):
    return explore.mean_by(stored_segments(spark, sf), "mois")


@query
def dept_stats(spark, sf):
    return explore.department_stats(stored_segments(spark, sf))


@query
def dept_top10(spark, sf):
    return explore.top_departments(explore.department_stats(stored_segments(spark, sf)), rows=10)


@query
def dept_top15_mean(spark, sf):
    return explore.top_departments(
        explore.department_stats(stored_segments(spark, sf)), "valeur_fonciere_mean", 15
    )


@query
def dept_extremes(spark, sf):
    return explore.extremes(explore.department_stats(stored_segments(spark, sf)))


@query
def dept_common(spark, sf):
    return explore.common_departments(stored_segments(spark, sf))


@query
def dept_common_prices(spark, sf):
    return explore.common_department_prices(explore.department_stats(stored_segments(spark, sf)))


@query
def dept_covered(spark, sf):
    return explore.covered(stored_segments(spark, sf))


@query
def histogram_100(spark, sf):
    return distribution.histogram(seg.cut(stored_silver(spark, sf), seg.FIRST_CUT), [], _PRICE, 100)


@query
def histogram_segment_50(spark, sf):
    return distribution.histogram(stored_segments(spark, sf), ["segment"], _PRICE, 50)


@query
def histogram_surface(spark, sf):
    return distribution.histogram(
        seg.iqr_filter(seg.price_segments(seg.cut(stored_silver(spark, sf)))), ["segment"], _SURFACE, 100
    )


@query
def histogram_log_price(spark, sf):
    found = distribution.histogram(
        explore.log_price(stored_segments(spark, sf)), ["segment"], "log_prix", 50
    )
    return _rounded(found, ["borne_min", "borne_max"], 6)


@query
def box_price(spark, sf):
    return distribution.box_plot(seg.cut(stored_silver(spark, sf), seg.FIRST_CUT), [], _PRICE)


@query
def box_segment_price(spark, sf):
    return distribution.box_plot(stored_segments(spark, sf), ["segment"], _PRICE)


@query
def box_surface(spark, sf):
    return distribution.box_plot(seg.cut(stored_silver(spark, sf)), [], _SURFACE)


@query
def ols_surface_price(spark, sf):
    found = distribution.linear_fit(stored_segments(spark, sf), ["segment"], _SURFACE, _PRICE)
    return _rounded(found, ["pente", "ordonnee", "y_min", "y_max"], 3)


@query
def ols_on_sample(spark, sf):
    """The line fitted on an exact sample of 30,000 rows per segment."""
    rows = distribution.exact_sample(stored_segments(spark, sf), ["segment"], "id_unique", 30_000)
    found = distribution.linear_fit(rows, ["segment"], _SURFACE, _PRICE)
    return _rounded(found, ["pente", "ordonnee", "y_min", "y_max"], 3)


@query
def sample_rows(spark, sf):
    """Exactly 10,000 rows, or all there are."""
    rows = distribution.exact_sample(stored_silver(spark, sf), [], "id_unique", 10_000)
    return rows.select("id_unique", "commune", _PRICE)


@query
def target_distribution(spark, sf):
    found = explore.target_distribution(stored_segments(spark, sf), ["segment"])
    return _rounded(_rounded(found, ["ecart_type"]), ["asymetrie"], 6)


@query
def describe_columns(spark, sf):
    found = distribution.describe(stored_silver(spark, sf), [_PRICE, _SURFACE, "nombre_pieces_principales"])
    return _rounded(found, ["mean", "std"])


# --- features ---------------------------------------------------------------------------


SEGMENTS = (1, 2, 3)


@query
def temporal_features(spark, sf):
    """Days are counted from the first date of the row's segment."""
    rows = stored_segments(spark, sf)
    first = F.broadcast(rows.groupBy("segment").agg(F.min("date_mutation").alias("_first")))
    built = features.temporal_features(rows.join(first, "segment"), F.col("_first"))
    waves = ["mois_sin", "mois_cos", "jour_semaine_sin", "jour_semaine_cos"]
    return _rounded(built, waves, 6).select(
        "segment", "id_unique", "annee", "mois", "trimestre", "jour_semaine", "jour_annee", *waves,
        "jours_depuis_debut",
    )


@query
def surface_features(spark, sf):
    built = features.surface_features(stored_segments(spark, sf))
    return _rounded(built, ["log_surface"], 6).select(
        "segment", "id_unique", "prix_m2", "categorie_surface", "log_surface", "surface_squared",
        "surface_par_piece",
    )


@query
def geographic_features(spark, sf):
    """Department figures are those of the row's segment."""
    rows = explore.with_department(features.surface_features(stored_segments(spark, sf)))
    stored = stage_table(rows, "surface")
    built = features.geographic_features(stored, features.full_stats(stored, ["segment"]))
    return _rounded(built, ["ratio_prix_dept"], 6).select(
        "segment", "id_unique", "code_postal", "departement",
        *[c for c in built.columns if c.startswith("dept_")], "ratio_prix_dept",
    )


@query
def interaction_features(spark, sf):
    return _rounded(stored_engineered(spark, sf), ["dept_prix_x_surface"], 2).select(
        "segment", "id_unique", "annee_x_surface", "dept_prix_x_surface", "type_local_x_surface_cat"
    )


@query
def feature_frame(spark, sf):
    """The engineered features of every row after encoding, each segment by its own levels."""
    rows = stored_engineered(spark, sf).withColumn("part_date", F.col("part_date").cast("string"))
    chosen = ["type_local", "nature_mutation", "fichier_source", "part_date", "departement",
              "categorie_surface", "type_local_x_surface_cat"]
    encoded = encoded_by(rows, "segment", SEGMENTS, chosen)
    flags = [c for c in encoded.columns if c.startswith("nature_mutation_")]
    return encoded.select(
        "segment", "id_unique", "lot", "pli", "mois", "jours_depuis_debut", "surface_par_piece", "prix_m2", "dept_valeur_fonciere_mean",
        F.col("departement_encoded").cast("int").alias("departement_encoded"),
        *[F.col(f"`{c}`").cast("int").alias(c.replace("-", "_").replace(" ", "_")) for c in flags],
    )


@query
def one_hot(spark, sf):
    encoded = encoded_by(stored_engineered(spark, sf), "segment", SEGMENTS, ["categorie_surface"])
    names = {"Très petit": "tres_petit", "Petit": "petit", "Moyen": "moyen", "Grand": "grand",
             "Très grand": "tres_grand", "nan": "manquant"}
    return encoded.select(
        "segment", "id_unique",
        *[(F.col(f"categorie_surface_{v}").cast("int") if f"categorie_surface_{v}" in encoded.columns else F.lit(0)).alias(n)
          for v, n in names.items()],
    )


@query
def label_codes(spark, sf):
    """Codes in sorted order, fitted on all lots of a segment together."""
    rows = stored_engineered(spark, sf)
    encoded = encoded_by(rows, "segment", SEGMENTS, ["type_local_x_surface_cat", "departement"], one_hot=0)
    return encoded.select("segment", "id_unique", "type_local_x_surface_cat_encoded", "departement_encoded")


@query
def train_dept_stats(spark, sf):
    """Department figures of the training rows."""
    train = stored_features(spark, sf).where(F.col("lot") == "train")
    return _rounded(
        features.training_stats(train).table,
        ["dept_mean_price", "dept_median_price", "dept_std_price", "dept_mean_surface"],
    )


@query
def safe_validation(spark, sf):
    """Validation rows with training figures and, in parity mode, the price ratio."""
    val = models.safe_lots(stored_features(spark, sf), parity=True).val
    return _rounded(
        val.select("id_unique", "departement", "dept_mean_price", "ratio_prix_dept"),
        ["dept_mean_price", "ratio_prix_dept"], 4,
    )


@query
def split_lots(spark, sf):
    return models.with_lot(silver(spark, sf)).select("id_unique", "lot")


@query
def split_folds(spark, sf):
    return models.with_fold(silver(spark, sf)).select("id_unique", "pli")


@query
def date_parts(spark, sf):
    return features.split_dates(
        silver(spark, sf).select("id_unique", "date_mutation"), ["date_mutation"]
    )


@query
def date_like_columns(spark, sf):
    """Which text columns read as dates."""
    rows = silver(spark, sf).select(
        F.col("date_mutation").cast("string").alias("date_texte"), "commune", "nature_mutation"
    )
    found = features.date_like(stage_table(rows, "texts"), rows.columns)
    return rows.agg(
        *[F.count(c).alias(c) for c in rows.columns]
    ).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.lit(c in found).alias("date"), F.col(c).alias("lignes"))
        for c in rows.columns
    ])))


@query
def dates_converted(spark, sf):
    """Text columns that read as dates turned into date parts."""
    rows = silver(spark, sf).select("id_unique", F.col("date_mutation").cast("string").alias("date_texte"), "commune")
    return features.dates_found(stage_table(rows, "texts"), ["date_texte", "commune"]).drop("commune")


@query
def year_moved(spark, sf):
    return silver(spark, sf).select(
        "id_unique", move_to_year(F.col("date_mutation"), PROJECTION_YEAR).alias("date_projetee")
    )


@query
def combined_common(spark, sf):
    """Segments put together over their common columns."""
    rows = stored_segments(spark, sf)
    one = rows.where("segment = 1").drop("nombre_pieces_principales")
    two = rows.where("segment = 2").withColumn("extra", F.lit(1))
    joined = features.combine([one, two])
    return joined.groupBy("segment").agg(
        F.count(F.lit(1)).alias("lignes"), F.lit(len(joined.columns)).alias("colonnes")
    )


@query
def combined_all(spark, sf):
    """Segments put together over all columns, 0 where one is missing."""
    rows = stored_segments(spark, sf)
    one = rows.where("segment = 1").drop("nombre_pieces_principales")
    two = rows.where("segment = 2").withColumn("extra", F.lit(1))
    joined = features.combine([one, two], common_only=False)
    return joined.groupBy("segment").agg(
        F.count(F.lit(1)).alias("lignes"), F.sum("extra").alias("extra"),
        F.sum("nombre_pieces_principales").alias("pieces"),
    )


@query
def numbers_coerced(spark, sf):
    """Text columns as numbers, 0 where there is none."""
    rows = features.as_numbers(testdata.mutations(spark, sf), [_PRICE, _SURFACE, "code_postal", "commune"])
    return rows.groupBy("fichier_source").agg(
        half_even(F.sum(_PRICE), 2).alias("prix"), F.sum(_SURFACE).alias("surface"),
        F.sum("code_postal").alias("codes"), F.sum("commune").alias("communes"),
    )


@query
def gaps_imputed(spark, sf):
    """Missing price, surface and rooms replaced by the column median."""
    rows = stage_table(clean.typed(testdata.mutations(spark, sf)), "typed")
    filled = features.impute_median(rows, [_PRICE, _SURFACE, "nombre_pieces_principales"])
    return filled.groupBy("fichier_source").agg(
        F.count(F.lit(1)).alias("lignes"),
        half_even(F.sum(F.col(_PRICE).cast("double")), 2).alias("prix"),
        F.sum(F.col(_SURFACE).cast("double")).alias("surface"),
        F.sum(F.col("nombre_pieces_principales").cast("double")).alias("pieces"),
    )


@query
def complete_rows(spark, sf):
    """Rows without a missing or infinite number."""
    rows = clean.typed(testdata.mutations(spark, sf))
    kept = features.complete_rows(rows, [_PRICE, _SURFACE, "nombre_pieces_principales"])
    return kept.groupBy("fichier_source").agg(F.count(F.lit(1)).alias("lignes"))


@query
def robust_scaled(spark, sf):
    """Scales learnt on the training rows of the row's segment."""
    rows = stored_engineered(spark, sf)
    columns = [_SURFACE, "jours_depuis_debut", "surface_par_piece"]
    scaled = scaled_by(rows, rows.where(F.col("lot") == "train"), "segment", columns)
    return _rounded(scaled.select("segment", "id_unique", *columns), columns, 6)


@query
def standard_scaled(spark, sf):
    rows = stored_features(spark, sf)
    columns = [_SURFACE, "jours_depuis_debut"]
    scaler = standard_scaler(rows.where(F.col("lot") == "train"), columns)
    return _rounded(scaler.transform(rows).select("id_unique", *columns), columns, 6)


@query
def mutual_information(spark, sf):
    """Binned mutual information of three features with the price."""
    train = stored_features(spark, sf).where(F.col("lot") == "train")
    found = models.mutual_information(train, [_SURFACE, "prix_m2", "jour_annee"])
    return _rounded(found, ["information"], 6)


@query
def prepared_lots(spark, sf):
    """Rows per lot of all three segments, prepared one by one and put together."""
    ready = analysis.prepare_all(stored_segments(spark, sf))
    found = None
    for name, lot in analysis.combined_lots(ready).items():
        part = lot.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("lot"), "lignes")
        found = part if found is None else found.unionByName(part)
    return found


# --- models -----------------------------------------------------------------------------


@query
def linear_surface(spark, sf):
    """Least squares on one feature in each segment, by the distributed learner."""
    return _surface_lines(spark, sf, lambda rows: models.linear_regression())


@query
def ridge_surface(spark, sf):
    """Ridge on one feature in each segment, by the distributed learner."""
    return _surface_lines(spark, sf, lambda rows: models.ridge(rows, alpha=1000.0))


def _surface_lines(spark, sf, learner) -> DataFrame:
    found = None
    for segment in SEGMENTS:
        rows = stored_segments(spark, sf).where(F.col("segment") == segment).select("segment", _SURFACE, _PRICE)
        model = models.fit("line", learner(rows), rows, [_SURFACE]).model
        part = rows.groupBy("segment").agg(
            F.count(F.lit(1)).alias("lignes"),
            F.lit(round(float(model.coefficients[0]), 2) + 0.0).alias("pente"),
            F.lit(round(float(model.intercept), 1) + 0.0).alias("ordonnee"),
        )
        found = part if found is None else found.union(part)
    return found


# All numeric leak-free features but ``dept_densite_transactions``, which repeats the department's count.
MEASURES = [
    _SURFACE, "nombre_pieces_principales", "annee", "mois", "trimestre", "jour_semaine", "jour_annee", "mois_sin", "mois_cos",
    "jour_semaine_sin", "jour_semaine_cos", "jours_depuis_debut", "log_surface", "surface_squared", "surface_par_piece",
    "annee_x_surface", "dept_surface_reelle_bati_mean", "dept_surface_reelle_bati_median", "dept_valeur_fonciere_count",
]
LINEAR = {"Linear Regression": 0.0, "Ridge": 1.0}


def _group_models(spark, sf) -> gram.GroupModels:
    """Gram blocks of the training rows of all segments; ridge is that of robust-scaled columns."""
    train = stored_all_features(spark, sf).where(F.col("lot") == "train")
    quartiles = distribution.summarize(train, ["segment"], MEASURES, (0.25, 0.75)).collect()
    spans = {(r["segment"], r["variable"]): (r["p75"] - r["p25"]) or 1.0 for r in quartiles}
    widths = {s: np.array([spans[s, c] for c in MEASURES]) for s in {s for s, _ in spans}}
    return gram.group_models(train, "segment", "pli", MEASURES, _PRICE, widths)


def _significant(value: float, digits: int = 5) -> float:
    """``value`` to so many digits."""
    if not value:
        return 0.0
    power = math.floor(math.log10(abs(value))) - digits + 1
    scale = 10.0 ** abs(power)
    return float(np.rint(value / scale) * scale if power > 0 else np.rint(value * scale) / scale)


@query
def linear_coefficients(spark, sf):
    """Least squares and ridge on all numeric features of each segment's training rows."""
    found = _group_models(spark, sf)
    rows = [
        (segment, name, variable or "constante", _significant(value))
        for segment in found.groups() for name, alpha in LINEAR.items() for variable, value in found.coefficients(segment, alpha).items()
    ]
    return spark.createDataFrame(rows, "segment int, modele string, variable string, coefficient double")


@query
def linear_folds(spark, sf):
    """Error of both on each fold of the training rows, learnt on the four others."""
    found = _group_models(spark, sf)
    rows = [
        (segment, name, fold, learnt, held, _significant(rmse, 8), float(np.rint(r2 * 1e6) / 1e6) + 0.0)
        for segment in found.groups() for name, alpha in LINEAR.items() for fold, learnt, held, rmse, r2 in found.folds(segment, alpha)
    ]
    return spark.createDataFrame(rows, "segment int, modele string, pli int, appris long, tenus long, rmse double, r2 double")


@query
def information_ranking(spark, sf):
    """The ten measures that tell most about the price, per segment, by nearest neighbours over all training rows."""
    train = stored_all_features(spark, sf).where(F.col("lot") == "train")
    found = neighbours.neighbour_information(train, "segment", MEASURES, _PRICE, "id_unique")
    # A segment has one row per measure.
    place = F.row_number().over(Window.partitionBy("segment").orderBy(F.desc("information"), "variable"))
    return found.withColumn("rang", place).where(F.col("rang") <= 10).select(F.col("segment").cast("int").alias("segment"), "rang", "variable", "information")


def _fold_stats(spark, sf) -> DataFrame:
    def build():
        train = stored_all_features(spark, sf).where(F.col("lot") == "train")
        return foldstats.department_folds(train, ["segment", "departement"])

    return stored(spark, sf, "fold-stats", build)


@query
def fold_dept_stats(spark, sf):
    """Department figures of each segment's training rows without each of five folds."""
    return _rounded(_fold_stats(spark, sf), ["dept_mean_price", "dept_median_price", "dept_std_price", "dept_mean_surface"])


# Measures of the row itself, and the department figures that a fold may know.
OWN_MEASURES = [c for c in MEASURES if not c.startswith("dept_")]
FOLD_MEASURES = [*OWN_MEASURES, "dept_mean_price", "dept_median_price", "dept_std_price", "dept_count_trans", "dept_mean_surface"]


@query
def fold_cross_validation(spark, sf):
    """Least squares on measures and department figures, where a fold's model and its figures come from the other
    folds; every training row is scored once."""
    train = stored_all_features(spark, sf).where(F.col("lot") == "train").select("segment", "departement", "pli", _PRICE, *OWN_MEASURES)
    joined = train.join(_fold_stats(spark, sf), ["segment", "departement"]).dropna(subset=FOLD_MEASURES)
    keyed = joined.withColumns({"modele": F.col("segment") * 100 + F.col("held"), "tenu": (F.col("pli") == F.col("held")).cast("int")})
    found = gram.group_models(keyed, "modele", "tenu", FOLD_MEASURES, _PRICE)
    rows = []
    for number in found.groups():
        learnt, held = (found.blocks.get((number, tenu)) for tenu in (0, 1))
        if learnt and held:
            rmse, r2 = held.errors(learnt.solve())
            rows.append((*divmod(number, 100), learnt.rows, held.rows, _significant(rmse, 8), float(np.rint(r2 * 1e6) / 1e6) + 0.0))
    return spark.createDataFrame(rows, "segment int, pli int, appris long, tenus long, rmse double, r2 double")


@query
def boosting_splits(spark, sf):
    """The first split of each segment's first leaf-wise tree, from the histograms of all its training rows."""
    train = stored_all_features(spark, sf).where(F.col("lot") == "train")
    found = boosting.fit(train, "segment", MEASURES, _PRICE, boosting.Settings(rounds=1, depth=1))
    rows = []
    for segment, (tree,) in found.trees.items():
        if tree.feature:
            edge = float(found.edges[tree.feature[0]][tree.bin[0]])
            rows.append((segment, MEASURES[tree.feature[0]], _significant(edge, 8), _significant(tree.gain[0], 8)))
    return spark.createDataFrame(rows, "segment int, variable string, borne double, gain double")


@query
def boosted_scores(spark, sf):
    """A hundred leaf-wise trees per segment, learnt on all its training rows, on its validation and test rows."""
    rows = stored_all_features(spark, sf)
    found = boosting.fit(rows.where(F.col("lot") == "train"), "segment", MEASURES, _PRICE)
    checked = rows.where(F.col("lot") != "train").select("segment", "lot", _PRICE, *MEASURES)
    return models.metrics(found.predict(checked, "segment"), ["segment", "lot"])


def _scored(spark, sf) -> DataFrame:
    """Validation and test rows with the training mean of their segment and department as prediction."""

    def build():
        safe = models.safe_lots(stored_engineered(spark, sf), keys=["segment"])
        both = safe.val.withColumn("lot", F.lit("val")).unionByName(safe.test.withColumn("lot", F.lit("test")))
        return both.where(F.col("dept_mean_price").isNotNull()).withColumn("prediction", F.col("dept_mean_price"))

    return stored(spark, sf, "scored", build)


@query
def baseline_metrics(spark, sf):
    """Metrics of the department mean as a prediction."""
    found = models.metrics(_scored(spark, sf), ["segment", "lot"])
    return _rounded(_rounded(found, ["mse"], 0), ["rmse", "mae", "r2", "mape"], 4)


@query
def baseline_residuals(spark, sf):
    return _rounded(
        models.residuals(_scored(spark, sf), ["segment", "lot"]), ["moyenne", "ecart_type", "mediane"]
    )


_PREPARED: dict[tuple, tuple] = {}


def _learnt(spark, sf, segment: int):
    """The prepared lots of a segment and its four fitted models, once per application."""
    key = (spark.sparkContext.applicationId, sf, segment)
    if key not in _PREPARED:
        ready = analysis.prepare(stored_segments(spark, sf).where(F.col("segment") == segment))
        train, val, test = (stage_table(rows, name) for name, rows in ready.lots().items())
        fitted, _ = models.train_all(train, ready.columns, log_target=ready.log_target)
        _PREPARED[key] = fitted, val, test
    return _PREPARED[key]


def _by_segment(spark, sf, build) -> DataFrame:
    found = [build(*_learnt(spark, sf, segment)).withColumn("segment", F.lit(segment)) for segment in (1, 2)]
    return found[0].unionByName(found[1])


@query
def model_leaderboard(spark, sf):
    """Four regressors on the encoded, scaled frame of a segment, compared on its validation rows."""
    return _by_segment(spark, sf, lambda fitted, val, _: models.leaderboard(models.compare(fitted, val)))


@query
def model_test_score(spark, sf):
    """The model with the smallest validation error, on the test rows."""

    def build(fitted, val, test):
        best = models.leaderboard(models.compare(fitted, val)).first()["modele"]
        model = next(m for m in fitted if m.name == best)
        scored = stage_table(model.predict(test).select(F.lit(best).alias("modele"), _PRICE, "prediction"), "scored")
        return models.metrics(scored, ["modele"]).join(models.residuals(scored, ["modele"]), "modele")

    return _by_segment(spark, sf, build)


@query
def model_importances(spark, sf):
    """The ten weightiest features of the forest."""
    return _by_segment(
        spark, sf, lambda fitted, *_: models.importance_table(spark, next(m for m in fitted if m.name == "Random Forest"))
    )


@query
def model_leakage(spark, sf):
    """Validation error with all features, without department figures, and with figures
    learnt on the training rows."""
    rows = stored_features(spark, sf)
    train, val, _ = models.lots(rows)
    safe = models.safe_lots(rows, parity=True)
    frames = {
        "toutes": (train, val),
        "sans departement": tuple(models.without_department_figures(x) for x in (train, val)),
        "departement sur train": (safe.train, safe.val),
    }
    scores = None
    for name, (learn, check) in frames.items():
        columns = models.default_features(learn)
        learn, check = (features.complete_rows(x, columns) for x in (learn, check))
        forest = models.fit(name, models.random_forest(), learn, columns)
        score = models.metrics(forest.predict(check)).withColumn("jeu", F.lit(name))
        scores = score if scores is None else scores.unionByName(score)
    return scores


@query
def model_cross_validation(spark, sf):
    """Five folds of the training rows; every row is scored."""
    rows = features.leak_free(stored_features(spark, sf)).where(F.col("lot") == "train").drop("lot")
    columns = models.default_features(rows)
    train = stage_table(models.with_fold(features.complete_rows(rows, columns)), "scored_folds")
    return models.cross_validate(models.random_forest, train, columns)


@query
def model_folds(spark, sf):
    """Training rows per lot and fold that the models see."""
    return models.with_fold(stored_features(spark, sf)).groupBy("lot", "pli").agg(F.count(F.lit(1)).alias("lignes"))


@query
def model_log_target(spark, sf):
    """Whether the price of each segment is skewed enough for a logarithm."""
    found = explore.target_distribution(stored_segments(spark, sf), ["segment"])
    return found.select(
        "segment", half_even(F.col("asymetrie"), 6).alias("asymetrie"), (F.abs("asymetrie") > 1.5).alias("log")
    )


def _projection(spark, sf) -> DataFrame:
    return stored(spark, sf, "projection", lambda: analysis.study(second_segment(spark, sf), PROJECTION_YEAR))


@query
def projection_rows(spark, sf):
    """Every row moved to the projection year with its predicted price."""
    return _projection(spark, sf).select(
        "id_unique", "date_mutation", "annee", "mois", "departement", models.PREDICTION
    )


@query
def projection_dates(spark, sf):
    """The projected rows without their prediction."""
    return _projection(spark, sf).select("id_unique", "date_mutation", "annee", "mois", "departement")


@query
def projection_figures(spark, sf):
    """The summaries of predictions, on those of the fitted model: as many rows and departments as are projected."""
    rows = _projection(spark, sf)
    size = rows.agg(F.count(F.lit(1)).alias("lignes"), F.count_distinct("departement").alias("departements")).first()
    return models.prediction_summary(rows).withColumns({name: F.lit(size[name]) for name in ("lignes", "departements")})


@query
def projection_csv(spark, sf):
    """Predictions exported as CSV, read back and described."""
    path = fresh_path(spark, "csv")
    rows = _projection(spark, sf).select("departement", "mois", models.PREDICTION)
    tables.export_csv(rows, path)
    return distribution.describe(tables.import_csv(spark, path, rows.schema), [models.PREDICTION])


def _predicted(spark, sf) -> DataFrame:
    """Rows with the training mean of their department times a month factor as the
    predicted price: a prediction that SQL can follow."""

    def build():
        rows = stored_features(spark, sf)
        joined = models.safe_lots(rows).stats.apply(rows).where(F.col("dept_mean_price").isNotNull())
        return joined.withColumn(models.PREDICTION, F.col("dept_mean_price") * (1 + F.col("mois") / 100.0))

    return stored(spark, sf, "predicted", build)


@query
def predictions_by_department(spark, sf):
    return _rounded(models.by_department(_predicted(spark, sf)), ["prix_moyen"])


@query
def predictions_by_month(spark, sf):
    return _rounded(models.by_month(_predicted(spark, sf), "04"), ["prix_moyen"])


@query
def predictions_extremes(spark, sf):
    return _rounded(models.dearest_and_cheapest(_predicted(spark, sf)), ["prix_moyen"])


@query
def predictions_summary(spark, sf):
    return _rounded(models.prediction_summary(_predicted(spark, sf)), ["mediane", "moyenne"])


@query
def predictions_box_top10(spark, sf):
    """Box-plot figures of the departments with the most predictions."""
    found = distribution.box_plot(
        models.largest_departments(_predicted(spark, sf)),
        ["departement"], models.PREDICTION,
    )
    return _rounded(found, ["q1", "mediane", "q3", "moustache_basse", "moustache_haute"])


@query
def predicted_against_observed(spark, sf):
    both = _predicted(spark, sf)
    found = models.observed_and_predicted(both, both)
    return _rounded(found, ["prix_moyen", "prix_median", "ecart_type", "surface_moyenne"])


@query
def predicted_by_department(spark, sf):
    """Observed and predicted mean of the ten largest departments."""
    both = _predicted(spark, sf)
    return _rounded(models.department_comparison(both, both), ["prix_reel", "prix_predit"])


@query
def predicted_histogram(spark, sf):
    """Observed and predicted prices in 50 bins each."""
    both = _predicted(spark, sf)
    found = distribution.histogram(models.stacked(both, both), ["source"], "prix", 50)
    return _rounded(found, ["borne_min", "borne_max"], 4)


@query
def predicted_line(spark, sf):
    """Price on surface, observed and predicted, with the mean price per square metre."""
    both = _predicted(spark, sf)
    rows = models.stacked(both, both).where(F.col(_SURFACE) > 0)
    per_m2 = rows.groupBy("source").agg(F.avg(F.col("prix") / F.col(_SURFACE)).alias("prix_m2_moyen"))
    found = distribution.linear_fit(rows, ["source"], _SURFACE, "prix").join(per_m2, "source")
    return _rounded(found, ["pente", "ordonnee", "y_min", "y_max", "prix_m2_moyen"], 3)


@query
def department_list(spark, sf):
    """Sorted departments for the choice of one."""
    return explore.with_department(silver(spark, sf)).select("departement").distinct().orderBy("departement")


# --- streaming --------------------------------------------------------------------------


def _sent(spark, sf, times: int = 1) -> str:
    """Folder of message files, compressed: every message names its fields."""
    path = fresh_path(spark, "messages")
    for _ in range(times):
        messages.send(messages.to_messages(testdata.mutations(spark, sf)), path, compression="gzip")
    return path


def _ingested(spark, sf, stream: DataFrame, distinct: bool = False) -> str:
    target = fresh_path(spark, "stream")
    run = ingest.start_ingestion(stream, target, f"{target}/offsets", trigger_seconds=None, distinct=distinct)
    run.awaitTermination()
    return target


@query
def stream_bronze(spark, sf):
    """Messages through the stream into stored bronze rows."""
    incoming = messages.open_stream(spark, _sent(spark, sf), maxFilesPerTrigger="4")
    return ingest.stored_rows(spark, _ingested(spark, sf, ingest.bronze_stream(incoming)))


@query
def stream_audit(spark, sf):
    """Rows and state over all audited batches."""
    incoming = messages.open_stream(spark, _sent(spark, sf), maxFilesPerTrigger="4")
    target = _ingested(spark, sf, ingest.bronze_stream(incoming))
    return ingest.audit_rows(spark, target).groupBy("status").agg(F.sum("rows").alias("lignes"))


@query
def stream_without_replays(spark, sf):
    """All messages sent twice, over several triggers; each key is stored once."""
    incoming = messages.open_stream(spark, _sent(spark, sf, times=2), maxFilesPerTrigger="4")
    stored = ingest.stored_rows(spark, _ingested(spark, sf, ingest.bronze_stream(incoming), distinct=True))
    return stored.groupBy("commune").agg(
        F.count(F.lit(1)).alias("lignes"), F.sum(_PRICE).alias("total")
    )


@query
def stream_kpis(spark, sf):
    """Running count and mean price per commune."""
    incoming = messages.open_stream(spark, _sent(spark, sf), maxFilesPerTrigger="4")
    target = fresh_path(spark, "live")
    figures = live.running_counts(ingest.bronze_stream(incoming))
    live.start_refresh(figures, f"{target}/kpis", f"{target}/offsets", None).awaitTermination()
    return _rounded(live.latest(spark, f"{target}/kpis"), ["moyenne"])


@query
def stream_overview(spark, sf):
    """Rows, mean price and the five communes with the most sales, from the running figures."""
    incoming = messages.open_stream(spark, _sent(spark, sf), maxFilesPerTrigger="4")
    target = fresh_path(spark, "live")
    figures = live.running_counts(ingest.bronze_stream(incoming))
    live.start_refresh(figures, f"{target}/kpis", f"{target}/offsets", None).awaitTermination()
    return _rounded(live.overview(live.latest(spark, f"{target}/kpis")), ["moyenne"])


@query
def stream_events(spark, sf):
    """Running figures over the event table as a stream, through JSON and back."""
    incoming = (
        spark.readStream.schema(testdata.table_schema(spark, sf, "events"))
        .option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    body = F.to_json(F.struct("event_type", "value"))
    parsed = incoming.select(
        F.from_json(body, "event_type string, value double").alias("d")
    ).select("d.*")
    target = fresh_path(spark, "live")
    figures = live.running_counts(parsed, "event_type", "value")
    live.start_refresh(figures, f"{target}/kpis", f"{target}/offsets", None).awaitTermination()
    return _rounded(live.latest(spark, f"{target}/kpis"), ["moyenne"], 4)
