"""Bronze to silver: date window, duplicate removal, content key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.functions.numeric import single_precision
from parcelion.functions.text import row_key
from parcelion.schemas import DEDUP_KEY, SILVER


def date_window(bronze: DataFrame, start: date, end: date) -> DataFrame:
    """Rows dated in [start, end); a row without a date is in no window."""
    day = F.col("date_mutation")
    return bronze.where((day >= F.lit(start)) & (day < F.lit(end)))


def drop_duplicates(bronze: DataFrame) -> DataFrame:
    """One row per key of date, postal code, price, commune and type.

    The kept row is the smallest of its remaining columns. A minimum is combined before
    the shuffle, so copies of one key never meet in one task, as they would under a
    window function. Rows are sorted for it by the price first: it tells most keys apart
    without a look at their texts.
    """
    rest = [c for c in bronze.columns if c not in DEDUP_KEY]
    order = sorted(DEDUP_KEY, key=lambda c: c != "valeur_fonciere")
    kept = bronze.groupBy(*order).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*[F.col(c) if c in DEDUP_KEY else F.col(f"_row.{c}") for c in bronze.columns])


def duplicate_counts(bronze: DataFrame) -> DataFrame:
    """Rows and different keys per year, from one pass."""
    return (
        bronze.groupBy(*DEDUP_KEY)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(F.year("date_mutation").alias("annee"))
        .agg(F.sum("_rows").alias("lignes"), F.count(F.lit(1)).alias("gardees"))
    )


def retyped(bronze: DataFrame) -> DataFrame:
    """Bronze types put in place again, for stores that hold other ones: a date out of a
    timestamp, 32-bit precision in a double, 0 for missing numbers."""
    return bronze.withColumns(
        {
            "date_mutation": F.to_date("date_mutation"),
            "valeur_fonciere": single_precision(F.col("valeur_fonciere")),
            "surface_reelle_bati": single_precision(F.col("surface_reelle_bati")),
            "nombre_pieces_principales": F.coalesce(
                F.col("nombre_pieces_principales").try_cast("int"), F.lit(0)
            ),
        }
    )


def to_silver(
    bronze: DataFrame,
    year_from: int = 2021,
    year_to: int = 2024,
    ingestion_date: date | None = None,
) -> DataFrame:
    """Silver rows of the years [year_from, year_to), all months in one pass.

    The date belongs to the key, so duplicates over the whole window are those of each
    month.
    """
    window = date_window(retyped(bronze), date(year_from, 1, 1), date(year_to, 1, 1))
    today = F.current_date() if ingestion_date is None else F.lit(ingestion_date)
    return (
        drop_duplicates(window)
        .withColumns({"part_date": today, "id_unique": row_key(DEDUP_KEY)})
        .select(*SILVER.fieldNames())
    )


def undated(bronze: DataFrame) -> DataFrame:
    """How many bronze rows silver cannot hold because their date could not be read."""
    return bronze.agg(
        F.count(F.lit(1)).alias("lignes"),
        F.count_if(F.col("date_mutation").isNull()).alias("sans_date"),
    )
