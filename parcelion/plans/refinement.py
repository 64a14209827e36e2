"""Whole flows over stored layers: files to bronze, silver, gold, graph and key figures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from parcelion.operators import gold, graph, kpis
from parcelion.operators.clean import clean
from parcelion.operators.silver import to_silver
from parcelion.session import released_after
from parcelion.sources.raw import message_fields, scan_raw
from parcelion.sources.tables import replace_months


@dataclass(frozen=True)
class Layers:
    """Paths of the stored layers below one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def load_bronze(spark: SparkSession, files: str | Sequence[str], layers: Layers) -> DataFrame:
    """Batch counterpart of the message stream: raw files to the stored bronze table."""
    clean(message_fields(scan_raw(spark, files))).write.mode("overwrite").parquet(layers.path("bronze"))
    return spark.read.parquet(layers.path("bronze"))


def load_silver(
    spark: SparkSession, layers: Layers, year_from: int = 2021, year_to: int = 2024,
    ingestion_date: date | None = None,
) -> DataFrame:
    """Bronze to silver by year and month; a rerun replaces the months it writes."""
    bronze = spark.read.parquet(layers.path("bronze"))
    replace_months(to_silver(bronze, year_from, year_to, ingestion_date), layers.path("silver"))
    return spark.read.parquet(layers.path("silver")).drop("annee", "mois")


def load_gold(spark: SparkSession, layers: Layers) -> gold.Star:
    """Silver to the stored star schema, the stored cube and the three views."""
    silver = spark.read.parquet(layers.path("silver")).drop("annee", "mois")
    with released_after(spark):
        built = gold.build_star(silver)
        for name, table in vars(built).items():
            table.write.mode("overwrite").parquet(layers.path(f"gold/{name}"))
    gold.sales_cube(silver).write.mode("overwrite").parquet(layers.path("gold/cube_ventes"))
    spark.read.parquet(layers.path("gold/cube_ventes")).createOrReplaceTempView("cube_ventes")
    star = gold.Star(**{name: spark.read.parquet(layers.path(f"gold/{name}")) for name in vars(built)})
    gold.register_views(star)
    return star


def load_graph(spark: SparkSession, layers: Layers) -> graph.Graph:
    """Silver to the stored node and edge tables."""
    silver = spark.read.parquet(layers.path("silver")).drop("annee", "mois")
    with released_after(spark):
        graph.save_graph(graph.build_graph(silver), layers.path("graph"))
    return graph.load_graph(spark, layers.path("graph"))


def load_key_values(spark: SparkSession, layers: Layers) -> DataFrame:
    """Bronze to the stored key figures."""
    bronze = spark.read.parquet(layers.path("bronze"))
    with released_after(spark):
        kpis.save_key_values(kpis.key_values(bronze), layers.path("kpis"))
    return spark.read.parquet(layers.path("kpis"))
