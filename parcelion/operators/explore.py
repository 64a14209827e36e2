"""Comparison of price segments: summaries, time, departments, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelion.functions.numeric import half_even
from parcelion.functions.text import department, zero_pad
from parcelion.operators.distribution import spread, summarize

_PRICE = "valeur_fonciere"
_SURFACE = "surface_reelle_bati"


def with_department(df: DataFrame) -> DataFrame:
    """Five-digit postal code and its department."""
    return df.withColumns(
        {
            "code_postal": zero_pad(F.col("code_postal"), 5),
            "departement": department(F.col("code_postal")),
        }
    )


def group_summary(df: DataFrame, group: str, price: str = _PRICE) -> DataFrame:
    """Rows, mean, median and sample deviation of the price and mean surface per group."""
    figures = summarize(df, [group], [price, _SURFACE])
    return spread(
        figures,
        [group],
        {
            "nombre": (price, F.col("n")),
            "prix_moyen": (price, F.col("mean")),
            "prix_median": (price, F.col("p50")),
            "ecart_type": (price, F.col("std")),
            "surface_moyenne": (_SURFACE, F.col("mean")),
        },
    )


# Row labels of the comparison table.
INDICATORS = {
    "nombre": "Nombre de transactions",
    "prix_moyen": "Prix moyen (€)",
    "prix_median": "Prix médian (€)",
    "ecart_type": "Écart-type prix",
    "surface_moyenne": "Surface moyenne (m²)",
}


def comparison_table(summary: DataFrame, group: str, columns: dict[object, str]) -> DataFrame:
    """The summary turned round: one row per indicator, one column per group, rounded to
    units."""
    long = summary.select(
        group,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(label).alias("indicateur"), F.col(c).cast("double").alias("v"))
                    for c, label in INDICATORS.items()
                ]
            )
        ),
    )
    cells = [
        half_even(F.max(F.when(F.col(group) == value, F.col("v")))).alias(name)
        for value, name in columns.items()
    ]
    return long.groupBy("indicateur").agg(*cells)


def price_per_m2(df: DataFrame) -> DataFrame:
    """Mean price per square metre per segment over rows with a surface."""
    return (
        df.where(F.col(_SURFACE) > 0)
        .groupBy("segment")
        .agg(F.avg(F.col(_PRICE) / F.col(_SURFACE)).alias("prix_m2_moyen"))
    )


def mean_by(df: DataFrame, part: str) -> DataFrame:
    """Mean price per segment and ``annee`` or ``mois``."""
    step = {"annee": F.year, "mois": F.month}[part]("date_mutation")
    return (
        df.where(F.col("date_mutation").isNotNull())
        .groupBy("segment", step.alias(part))
        .agg(F.avg(_PRICE).alias("prix_moyen"))
    )


def department_stats(df: DataFrame) -> DataFrame:
    """Per segment and department: count, mean, median and sample deviation of the price,
    mean and median of the surface, rounded to units."""
    keys = ["segment", "departement"]
    figures = summarize(with_department(df), keys, [_PRICE, _SURFACE])
    return spread(
        figures,
        keys,
        {
            "valeur_fonciere_count": (_PRICE, F.col("n")),
            "valeur_fonciere_mean": (_PRICE, half_even(F.col("mean"))),
            "valeur_fonciere_median": (_PRICE, half_even(F.col("p50"))),
            "valeur_fonciere_std": (_PRICE, half_even(F.col("std"))),
            "surface_reelle_bati_mean": (_SURFACE, half_even(F.col("mean"))),
            "surface_reelle_bati_median": (_SURFACE, half_even(F.col("p50"))),
        },
    )


def top_departments(stats: DataFrame, by: str = "valeur_fonciere_count", rows: int = 15) -> DataFrame:
    """Leading departments of each segment; the code settles ties. The window runs over
    one row per department."""
    order = Window.partitionBy("segment").orderBy(F.desc(by), "departement")
    return stats.withColumn("rang", F.row_number().over(order)).where(F.col("rang") <= rows)


def extremes(stats: DataFrame) -> DataFrame:
    """Dearest and cheapest department of each segment with its mean price, and how many
    departments there are. Ties go to the lowest code."""
    mean = F.col("valeur_fonciere_mean")
    high = F.min_by("departement", F.struct((-mean).alias("m"), "departement"))
    low = F.min_by("departement", F.struct(mean.alias("m"), "departement"))
    return stats.groupBy("segment").agg(
        F.count(F.lit(1)).alias("departements"),
        high.alias("plus_cher"),
        F.max(mean).alias("prix_plus_cher"),
        low.alias("moins_cher"),
        F.min(mean).alias("prix_moins_cher"),
    )


def segment_departments(df: DataFrame) -> DataFrame:
    """Distinct departments of each segment."""
    return (
        with_department(df)
        .where(F.col("departement").isNotNull())
        .select("segment", "departement")
        .distinct()
    )


def common_departments(df: DataFrame, segments: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Departments that occur in every segment, sorted. A count over distinct pairs
    gives the intersection in one pass over the rows."""
    return (
        segment_departments(df)
        .where(F.col("segment").isin(*segments))
        .groupBy("departement")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == len(segments))
        .select("departement")
        .orderBy("departement")
    )


def common_department_prices(stats: DataFrame, rows: int = 10) -> DataFrame:
    """Mean price per segment for the first departments common to all three."""
    cells = {1: "prix_standard", 2: "prix_haut_gamme", 3: "prix_ultra"}
    prices = stats.groupBy("departement").agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.coalesce(
                F.max(F.when(F.col("segment") == s, F.col("valeur_fonciere_mean"))), F.lit(0.0)
            ).alias(name)
            for s, name in cells.items()
        ],
    )
    return prices.where(F.col("_n") == 3).drop("_n").orderBy("departement").limit(rows)


def covered(df: DataFrame) -> DataFrame:
    """Departments covered and national mean price per segment."""
    return (
        with_department(df)
        .groupBy("segment")
        .agg(
            F.count_distinct("departement").alias("departements"),
            F.avg(_PRICE).alias("prix_moyen_national"),
        )
    )


def log_price(df: DataFrame) -> DataFrame:
    """Rows with a positive price and its natural logarithm."""
    return df.where(F.col(_PRICE) > 0).withColumn("log_prix", F.ln(_PRICE))


def target_distribution(df: DataFrame, keys: Sequence[str] = (), column: str = _PRICE) -> DataFrame:
    """Min, max, median, sample deviation and population skewness of the target."""
    return summarize(df, keys, [column]).select(
        *keys, "n", "min", "max", F.col("p50").alias("mediane"), F.col("std").alias("ecart_type"),
        F.col("skew").alias("asymetrie"),
    )
