"""The sales cube kept up to date by signed deltas.

A cell holds sums that can be added and taken away: rows, price, surface and rows with a surface, the sums as decimals, so that what is
added and taken away again leaves nothing. When months are replaced, their old rows count negative and their new rows positive, the
deltas are added to the stored cells, and cells without rows go. Months that did not change are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ("type_local", "commune", "annee")
_SUMS = ("nb_ventes", "somme_valeur", "nb_valeurs", "somme_surface", "nb_surfaces")
_EXACT = "decimal(28,12)"


def cells(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Sums per cell of silver rows."""
    price, surface = (F.col(c).cast(_EXACT) for c in ("valeur_fonciere", "surface_reelle_bati"))
    counted = rows.groupBy("type_local", "commune", F.year("date_mutation").alias("annee")).agg(
        F.count(F.lit(1)).alias("nb_ventes"), F.sum(price).alias("somme_valeur"), F.count(price).alias("nb_valeurs"),
        F.sum(surface).alias("somme_surface"), F.count(surface).alias("nb_surfaces"),
    )
    return _signed(counted, sign)


def _signed(counted: DataFrame, sign: int) -> DataFrame:
    # A product of decimals would lose digits.
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,12)")
    return counted.select(*CELL, *[(whole(c) if sign > 0 else -whole(c)).alias(c) for c in _SUMS])


def merged(stored: DataFrame, *deltas: DataFrame) -> DataFrame:
    """Stored cells with deltas added; cells whose rows are all taken away go."""
    together = stored
    for delta in deltas:
        together = together.unionByName(delta)
    summed = together.groupBy(*CELL).agg(*[F.sum(c).cast("decimal(38,12)").alias(c) for c in _SUMS])
    return summed.where(F.col("nb_ventes") != 0)


def replaced(stored: DataFrame, old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The cube after ``old_rows`` gave way to ``new_rows``; both are rows of the replaced months only."""
    return merged(stored, cells(old_rows, -1), cells(new_rows))


def figures(cube: DataFrame) -> DataFrame:
    """The cube as users see it: sales, total price and mean surface; no price or surface at all gives NULL."""
    some = lambda c, n: F.when(F.col(n) != 0, F.col(c).cast("double"))
    return cube.select(
        *CELL, F.col("nb_ventes").cast("long").alias("nb_ventes"), some("somme_valeur", "nb_valeurs").alias("total_valeur_fonciere"),
        (some("somme_surface", "nb_surfaces") / F.col("nb_surfaces").cast("double")).alias("surface_moyenne"),
    )
