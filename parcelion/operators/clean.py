"""Typing and cleaning of message fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.functions.dates import parse_day
from parcelion.functions.numeric import single_precision


def typed(fields: DataFrame) -> DataFrame:
    """Date and numbers parsed; what cannot be read is NULL."""
    return fields.withColumns(
        {
            "date_mutation": parse_day(F.col("date_mutation")),
            "valeur_fonciere": F.col("valeur_fonciere").try_cast("float"),
            "surface_reelle_bati": F.col("surface_reelle_bati").try_cast("float"),
            "nombre_pieces_principales": F.col("nombre_pieces_principales").try_cast("int"),
        }
    )


def clean(fields: DataFrame) -> DataFrame:
    """Message fields to bronze rows, for a batch and for a stream alike.

    Price and surface carry 32-bit precision in a double, as a NULL-to-0.0 branch with
    a double literal yields; the room count is an integer with NULL as 0.
    """
    return fields.select(
        parse_day(F.col("date_mutation")).alias("date_mutation"),
        "nature_mutation",
        single_precision(F.col("valeur_fonciere")).alias("valeur_fonciere"),
        "code_postal",
        "commune",
        "type_local",
        single_precision(F.col("surface_reelle_bati")).alias("surface_reelle_bati"),
        F.coalesce(F.col("nombre_pieces_principales").try_cast("int"), F.lit(0)).alias(
            "nombre_pieces_principales"
        ),
        "fichier_source",
    )


def fill_defaults(typed_rows: DataFrame) -> DataFrame:
    """NULL price, surface and room count to 0, keeping the column types."""
    return typed_rows.fillna(
        {"valeur_fonciere": 0.0, "surface_reelle_bati": 0.0, "nombre_pieces_principales": 0}
    )


def repair_dates(df: DataFrame, column: str = "date_mutation") -> DataFrame:
    """Text dates to dates. ``date_etat`` says what happened to each row: ``modifie``,
    or ``ignore`` for text that is no date and for rows without one."""
    day = F.try_to_date(F.col(column), "d/M/yyyy")
    return df.withColumn("_day", day).withColumn(
        "date_etat", F.when(F.col("_day").isNotNull(), "modifie").otherwise("ignore")
    ).drop(column).withColumnRenamed("_day", column)


def repair_counts(repaired: DataFrame) -> DataFrame:
    """Number of dates changed and of rows passed over."""
    return repaired.agg(
        F.count_if(F.col("date_etat") == "modifie").alias("modifies"),
        F.count_if(F.col("date_etat") == "ignore").alias("ignores"),
    )
