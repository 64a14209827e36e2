"""Gold star schema: dimensions, fact, views, cube and integrity checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelion import schemas
from parcelion.functions.numeric import half_even
from parcelion.session import stage_table


def dense_codes(names: DataFrame, name: str, code: str, first: int = 0) -> DataFrame:
    """Consecutive numbers for distinct names in their sorted order.

    Names are range-partitioned and stored, numbered inside each partition, and moved up
    by the size of the partitions before it. No task sees all names; the offsets have one
    row per shuffle partition.
    """
    placed = stage_table(
        names.select(name).distinct().repartitionByRange(name)
        .withColumn("_part", F.spark_partition_id()),
        "codes",
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_part").orderBy(name)
    number = F.col("_offset") + F.row_number().over(inside) + (first - 1)
    return placed.join(F.broadcast(offsets), "_part").select(number.cast("int").alias(code), name)


def dimension(silver: DataFrame, column: str, id_name: str, name: str) -> DataFrame:
    """Distinct non-NULL names with ids from 1 on."""
    names = silver.where(F.col(column).isNotNull()).select(F.col(column).alias(name))
    return dense_codes(names, name, id_name, first=1)


def communes(silver: DataFrame) -> DataFrame:
    return dimension(silver, "commune", "id_commune", "nom_commune")


def types_locaux(silver: DataFrame) -> DataFrame:
    return dimension(silver, "type_local", "id_type", "type_local")


def natures_mutation(silver: DataFrame) -> DataFrame:
    return dimension(silver, "nature_mutation", "id_nature", "nature_mutation")


@dataclass(frozen=True)
class Star:
    """The four gold tables."""

    communes: DataFrame
    types_locaux: DataFrame
    natures_mutation: DataFrame
    transactions: DataFrame


def transactions(
    silver: DataFrame,
    dim_communes: DataFrame,
    dim_types: DataFrame,
    dim_natures: DataFrame,
    random_ids: bool = False,
) -> DataFrame:
    """Fact rows: silver with surrogate ids; a row with a NULL name joins nothing.

    ``id_transaction`` is a digest of ``id_unique`` unless random ids are asked for.
    """
    identity = F.expr("uuid()") if random_ids else F.sha2(F.concat(F.lit("t:"), "id_unique"), 256)
    return (
        silver.join(dim_communes, F.col("commune") == F.col("nom_commune"))
        .join(dim_types, "type_local")
        .join(dim_natures, "nature_mutation")
        .withColumn("id_transaction", identity)
        .select(*schemas.TRANSACTIONS.fieldNames())
    )


def build_star(silver: DataFrame, random_ids: bool = False) -> Star:
    """Gold tables from a stored silver table.

    Dimensions are stored before the fact joins them, so the join strategy follows their
    true size: broadcast while small, shuffle join with skew splitting otherwise.
    """
    dims = [stage_table(build(silver), "dim") for build in (communes, types_locaux, natures_mutation)]
    return Star(*dims, transactions(silver, *dims, random_ids=random_ids))


def detailed(star: Star) -> DataFrame:
    """Fact rows with the names put back."""
    return (
        star.transactions.join(star.communes, "id_commune")
        .join(star.types_locaux, "id_type")
        .join(star.natures_mutation, "id_nature")
        .select(
            "id_transaction", "code_postal", "nom_commune", "date_mutation", "fichier_source",
            "part_date", "valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales",
            "type_local", "nature_mutation",
        )
    )


def stats_by_commune(star: Star) -> DataFrame:
    """Sales, mean price and total surface per commune, most sales first.

    The fact is summed per id before the name is joined, so the join moves one row per
    commune.
    """
    per_id = star.transactions.groupBy("id_commune").agg(
        F.count(F.lit(1)).alias("nb_transactions"),
        half_even(F.avg("valeur_fonciere")).alias("valeur_moyenne"),
        half_even(F.sum("surface_reelle_bati")).alias("surface_totale"),
    )
    return (
        per_id.join(star.communes, "id_commune")
        .select("nom_commune", "nb_transactions", "valeur_moyenne", "surface_totale")
        .orderBy(F.desc("nb_transactions"), "nom_commune")
    )


def stats_by_type(star: Star) -> DataFrame:
    """Sales and mean price per type, dearest first."""
    per_id = star.transactions.groupBy("id_type").agg(
        F.count(F.lit(1)).alias("nb_ventes"),
        half_even(F.avg("valeur_fonciere")).alias("prix_moyen"),
    )
    return (
        per_id.join(star.types_locaux, "id_type")
        .select("type_local", "nb_ventes", "prix_moyen")
        .orderBy(F.desc("prix_moyen"), "type_local")
    )


def sales_cube(silver: DataFrame) -> DataFrame:
    """Sales, total price and mean surface per (type, commune, year); no subtotals."""
    return silver.groupBy(
        "type_local", "commune", F.year("date_mutation").alias("annee")
    ).agg(
        F.count(F.lit(1)).alias("nb_ventes"),
        F.sum("valeur_fonciere").alias("total_valeur_fonciere"),
        F.avg("surface_reelle_bati").alias("surface_moyenne"),
    )


def cube_totals(cube: DataFrame, year: int = 2022) -> DataFrame:
    """Total price per commune in one year of the cube."""
    return (
        cube.where(F.col("annee") == year)
        .groupBy("commune")
        .agg(F.sum("total_valeur_fonciere").alias("total_valeur_fonciere"))
    )


def register_views(star: Star) -> None:
    """The three gold views under the names users query."""
    detailed(star).createOrReplaceTempView("dl_gold_transactions_detaillees")
    stats_by_commune(star).createOrReplaceTempView("dl_gold_stats_par_commune")
    stats_by_type(star).createOrReplaceTempView("dl_gold_stats_par_type_local")


def integrity(star: Star) -> DataFrame:
    """Violations per rule: double names, double ids, orphan keys, missing primary keys.
    All zero on a sound star."""
    checks = []
    dims = [
        ("communes", star.communes, "id_commune", "nom_commune"),
        ("types_locaux", star.types_locaux, "id_type", "type_local"),
        ("natures_mutation", star.natures_mutation, "id_nature", "nature_mutation"),
    ]
    for label, dim, key, name in dims:
        for column in (key, name):
            doubles = dim.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            checks.append(_violations(f"{label}.{column} unique", doubles))
        # Keys are made distinct first: orphans are looked up once per key, not per row.
        used = star.transactions.select(key).distinct()
        checks.append(_violations(f"transactions.{key} exists", used.join(dim, key, "left_anti")))
    ids = star.transactions.groupBy("id_transaction").agg(F.count(F.lit(1)).alias("n"))
    checks.append(_violations("transactions.id_transaction unique", ids.where("n > 1")))
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def _violations(rule: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(rule).alias("regle"), "violations"
    )
