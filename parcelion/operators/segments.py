"""Outlier cuts, price segments and surface cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.operators.distribution import summarize

# Segment number, lowest and highest price, both included.
SEGMENTS = [
    (1, 10_000.0, 470_000.0),
    (2, 470_000.0, 1_300_000.0),
    (3, 1_300_000.0, 2_000_000.0),
]
FIRST_CUT = 500_000_000.0
SECOND_CUT = 2_000_000.0

_PRICE = "valeur_fonciere"
_SURFACE = "surface_reelle_bati"


def above(df: DataFrame, limits: tuple[float, ...] = (FIRST_CUT, SECOND_CUT)) -> DataFrame:
    """Number of prices above each limit, from one pass."""
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("seuil"), F.col(f"_{i}").alias("nb"))
            for i, x in enumerate(limits)
        ]
    )
    counted = df.agg(
        *[F.count_if(F.col(_PRICE) > x).alias(f"_{i}") for i, x in enumerate(limits)]
    )
    return counted.select(F.inline(cells))


def cut(df: DataFrame, limit: float = SECOND_CUT) -> DataFrame:
    """Rows priced at most ``limit``; a NULL price goes too."""
    return df.where(F.col(_PRICE) <= limit)


def price_segments(df: DataFrame, bounds: list[tuple[int, float, float]] | None = None) -> DataFrame:
    """Rows with the number of their price segment. Bounds belong to both neighbours, so
    a row on one appears twice. One scan serves all segments."""
    price = F.col(_PRICE)
    member = [
        F.when((price >= low) & (price <= high), F.lit(number))
        for number, low, high in (SEGMENTS if bounds is None else bounds)
    ]
    return df.select("*", F.explode(F.array_compact(F.array(*member))).alias("segment"))


def iqr_bounds(df: DataFrame, column: str = _SURFACE, factor: float = 1.5) -> DataFrame:
    """Lowest and highest accepted value per segment."""
    reach = factor * (F.col("p75") - F.col("p25"))
    quartiles = summarize(df, ["segment"], [column], (0.25, 0.75))
    return quartiles.select(
        "segment",
        (F.col("p25") - reach).alias("borne_inf"),
        (F.col("p75") + reach).alias("borne_sup"),
    )


def iqr_filter(df: DataFrame, column: str = _SURFACE, factor: float = 1.5) -> DataFrame:
    """Rows inside the accepted range of their segment.

    The bounds have one row per segment, three by default, so they are broadcast.
    """
    value = F.col(column)
    inside = (value >= F.col("borne_inf")) & (value <= F.col("borne_sup"))
    return (
        df.join(F.broadcast(iqr_bounds(df, column, factor)), "segment")
        .where(inside)
        .drop("borne_inf", "borne_sup")
    )


def without_surface(column: str = _SURFACE):
    return F.col(column).isNull() | (F.col(column) == 0)


def clean_segments(df: DataFrame) -> DataFrame:
    """Segmented rows after the outlier cuts, the range filter on surfaces and the
    removal of missing surfaces, in this order: the quartiles still see the zeros."""
    return iqr_filter(price_segments(cut(cut(df, FIRST_CUT)))).where(~without_surface())


def cleaning_counts(df: DataFrame) -> DataFrame:
    """Rows per segment before and after each cleaning step."""
    segmented = price_segments(cut(cut(df, FIRST_CUT)))
    value = F.col(_SURFACE)
    inside = (value >= F.col("borne_inf")) & (value <= F.col("borne_sup"))
    return (
        segmented.join(F.broadcast(iqr_bounds(segmented)), "segment")
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("lignes"),
            F.count_if(inside).alias("dans_bornes"),
            F.count_if(inside & without_surface()).alias("sans_surface"),
            F.count_if(inside & ~without_surface()).alias("gardees"),
        )
    )
