"""Feature engineering: calendar, surface, department and interaction features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelion.functions.dates import calendar_features, cyclic, date_parts
from parcelion.functions.numeric import finite_or_null, half_even, ratio
from parcelion.operators.distribution import quantile_name, spread, summarize
from parcelion.operators.explore import with_department
from parcelion.session import stage_table

_PRICE = "valeur_fonciere"
_SURFACE = "surface_reelle_bati"
_ROOMS = "nombre_pieces_principales"

# Upper bounds (included) and names of the surface classes.
SURFACE_CLASSES = [(50, "Très petit"), (100, "Petit"), (150, "Moyen"), (200, "Grand")]
LARGEST_CLASS = "Très grand"

# Features computed from the price of the row itself or of the whole set.
TARGET_DERIVED = [
    "prix_m2", "ratio_prix_dept", "dept_valeur_fonciere_mean", "dept_valeur_fonciere_median",
    "dept_valeur_fonciere_std", "dept_prix_x_surface",
]


def first_day(df: DataFrame, column: str = "date_mutation") -> date | None:
    """Earliest date of a frame: one value."""
    return df.agg(F.min(column)).first()[0]


def temporal_features(df: DataFrame, reference: date | Column) -> DataFrame:
    """Calendar parts, their position on the circle, and days since ``reference``."""
    day = F.col("date_mutation")
    reference = reference if isinstance(reference, Column) else F.lit(reference)
    parts = calendar_features(day)
    month_sin, month_cos = cyclic(parts["mois"], 12)
    week_sin, week_cos = cyclic(parts["jour_semaine"], 7)
    return df.withColumns(
        {
            **parts,
            "mois_sin": month_sin,
            "mois_cos": month_cos,
            "jour_semaine_sin": week_sin,
            "jour_semaine_cos": week_cos,
            "jours_depuis_debut": F.datediff(day, reference),
        }
    )


def surface_class(surface: Column) -> Column:
    """Class of a positive surface; a bound belongs to the class below it."""
    chain = F.when(surface <= 0, None)
    for bound, name in SURFACE_CLASSES:
        chain = chain.when(surface <= bound, name)
    return chain.when(surface.isNotNull(), LARGEST_CLASS)


def surface_features(df: DataFrame) -> DataFrame:
    """Surface features; rows without a surface or without rooms go."""
    surface = F.col(_SURFACE)
    return df.where((surface > 0) & (F.col(_ROOMS) > 0)).withColumns(
        {
            "prix_m2": F.col(_PRICE) / surface,
            "categorie_surface": surface_class(surface),
            "log_surface": F.log1p(surface),
            "surface_squared": surface * surface,
            "surface_par_piece": surface / F.col(_ROOMS),
        }
    )


@dataclass(frozen=True)
class DepartmentStats:
    """Department figures learnt from one frame and joined to any other.

    ``table`` is stored, so its true size decides between broadcast and shuffle join.
    """

    table: DataFrame
    keys: tuple[str, ...] = ("departement",)

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows with the figures of their department; unknown departments get NULL."""
        return df.join(self.table, list(self.keys), "left")


def full_stats(df: DataFrame, keys: Sequence[str] = ()) -> DepartmentStats:
    """Price mean, median, deviation and count, surface mean and median, to cents; per department within ``keys``."""
    by = [*keys, "departement"]
    figures = summarize(df, by, [_PRICE, _SURFACE])
    wanted = {
        f"dept_{column}_{label}": (column, half_even(F.col(source), 2))
        for column, labels in {
            _PRICE: {"mean": "mean", "median": "p50", "std": "std"},
            _SURFACE: {"mean": "mean", "median": "p50"},
        }.items()
        for label, source in labels.items()
    }
    wanted["dept_valeur_fonciere_count"] = (_PRICE, F.col("n"))
    return DepartmentStats(stage_table(spread(figures, by, wanted), "dept"), tuple(by))


def training_stats(train: DataFrame, keys: Sequence[str] = ()) -> DepartmentStats:
    """Department figures of the training rows only, unrounded; per department within ``keys``."""
    by = [*keys, "departement"]
    figures = summarize(train, by, [_PRICE, _SURFACE])
    return DepartmentStats(
        stage_table(
            spread(
                figures,
                by,
                {
                    "dept_mean_price": (_PRICE, F.col("mean")),
                    "dept_median_price": (_PRICE, F.col("p50")),
                    "dept_std_price": (_PRICE, F.col("std")),
                    "dept_count_trans": (_PRICE, F.col("n")),
                    "dept_mean_surface": (_SURFACE, F.col("mean")),
                },
            ),
            "dept-train",
        ),
        tuple(by),
    )


def geographic_features(df: DataFrame, stats: DepartmentStats) -> DataFrame:
    """Department figures, price over department mean, number of sales as density."""
    return stats.apply(df).withColumns(
        {
            "ratio_prix_dept": ratio(F.col(_PRICE), F.col("dept_valeur_fonciere_mean")),
            "dept_densite_transactions": F.col("dept_valeur_fonciere_count"),
        }
    )


def interaction_features(df: DataFrame) -> DataFrame:
    """Year times surface, department mean times surface, type with surface class."""
    crossed = {
        "annee_x_surface": F.col("annee") * F.col(_SURFACE),
        "type_local_x_surface_cat": F.concat(
            F.coalesce("type_local", F.lit("None")), F.lit("_"), F.coalesce("categorie_surface", F.lit("nan"))
        ),
    }
    if "dept_valeur_fonciere_mean" in df.columns:
        crossed["dept_prix_x_surface"] = F.col("dept_valeur_fonciere_mean") * F.col(_SURFACE)
    return df.withColumns(crossed)


def engineered(df: DataFrame) -> DataFrame:
    """All features before encoding, with department figures of the whole frame.

    ``df`` is read three times (first date, department figures, result): pass a stored
    table.
    """
    # The reference day is that of the whole frame, before rows without a surface go.
    reference = first_day(df)
    rows = surface_features(temporal_features(with_department(df), reference))
    return interaction_features(geographic_features(rows, full_stats(rows)))


def engineered_by(df: DataFrame, key: str = "segment") -> DataFrame:
    """The features of :func:`engineered` for every value of ``key`` at once: first day and department figures are those
    of the row's own group. There are few groups: the first days are one row each."""
    first = F.broadcast(df.groupBy(key).agg(F.min("date_mutation").alias("_first")))
    dated = temporal_features(with_department(df).join(first, key), F.col("_first")).drop("_first")
    rows = surface_features(dated)
    return interaction_features(geographic_features(rows, full_stats(rows, [key])))


def leak_free(df: DataFrame) -> DataFrame:
    """Without the features that know the price of the row or of the whole set."""
    return df.drop(*[c for c in TARGET_DERIVED if c in df.columns])


def split_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric parts in place of date columns."""
    for column in columns:
        parts = {f"{column}_{k}": v for k, v in date_parts(F.col(column)).items()}
        df = df.withColumns(parts).drop(column)
    return df


def date_like(df: DataFrame, columns: list[str], share: float = 0.9) -> list[str]:
    """Text columns of whose values at least ``share`` read as dates: one aggregate over all rows and columns."""
    if not columns:
        return []
    counts = {f"_{kind}_{i}": F.count(value) for i, c in enumerate(columns)
              for kind, value in (("n", F.col(f"`{c}`")), ("dates", F.col(f"`{c}`").try_cast("timestamp")))}
    row = df.agg(*[count.alias(name) for name, count in counts.items()]).first()
    return [c for i, c in enumerate(columns) if row[f"_n_{i}"] and row[f"_dates_{i}"] >= share * row[f"_n_{i}"]]


def dates_found(df: DataFrame, columns: list[str], share: float = 0.9) -> DataFrame:
    """Text columns that read as dates (see :func:`date_like`) turned into date parts;
    values that do not read as a date give NULL parts."""
    found = date_like(df, columns, share)
    typed = df.withColumns({c: F.to_date(F.col(c).try_cast("timestamp")) for c in found}) if found else df
    return split_dates(typed, found)


def numeric_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    """Columns of a numeric type."""
    kinds = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [name for name, kind in df.dtypes if kind in kinds and name not in without]


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def drop_prefixed(df: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def as_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as doubles, 0 where there is no number."""
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(0.0)) for c in columns}
    )


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns``, in order; missing ones are 0."""
    return df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns]
    )


def shared_columns(*frames: DataFrame) -> tuple[list[str], list[str]]:
    """Columns common to all frames, and all columns of any, both sorted."""
    names = [set(f.columns) for f in frames]
    return sorted(set.intersection(*names)), sorted(set.union(*names))


def combine(frames: list[DataFrame], common_only: bool = True) -> DataFrame:
    """Rows of all frames over their common columns, or over all columns with 0."""
    common, union = shared_columns(*frames)
    columns = common if common_only else union
    result = align(frames[0], columns)
    for frame in frames[1:]:
        result = result.unionByName(align(frame, columns))
    return result


def finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL for NaN and infinite numbers."""
    floating = {name for name, kind in df.dtypes if kind in ("float", "double")}
    return df.withColumns(
        {c: finite_or_null(F.col(f"`{c}`")) for c in columns if c in floating}
    )


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which no listed number is missing, NaN or infinite."""
    return finite(df, columns).dropna("any", subset=[f"`{c}`" for c in columns])


def column_quantiles(df: DataFrame, columns: list[str], quantiles: tuple[float, ...]) -> dict[str, tuple]:
    """Exact quantiles of each column: one row per column comes to the driver."""
    rows = summarize(df, [], columns, quantiles).collect()
    names = [quantile_name(q) for q in quantiles]
    return {r["variable"]: tuple(r[n] for n in names) for r in rows}


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing and infinite numbers replaced by the column's exact median; the columns are
    doubles, whether or not a value is missing.

    Only columns that miss a value enter the median job.
    """
    tidy = finite(df, columns)
    misses = tidy.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]).first()
    gaps = [c for c in columns if misses[c] > 0]
    medians = {c: m[0] for c, m in column_quantiles(tidy, gaps, (0.5,)).items()} if gaps else {}
    return tidy.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(medians.get(c)).cast("double")) for c in columns}
    )
