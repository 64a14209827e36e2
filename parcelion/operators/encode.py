"""Categorical encoding and scaling, fitted on one frame and applied to any."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelion.operators.distribution import spread, summarize
from parcelion.operators.features import column_quantiles, combine
from parcelion.operators.gold import dense_codes
from parcelion.session import stage_table

ONE_HOT_LEVELS = 10
# Identifiers and free names that are no features.
NOT_ENCODED = {"id_unique", "commune", "code_postal", "date_mutation", "valeur_fonciere"}
_MISSING = "nan"


def categorical_columns(df: DataFrame) -> list[str]:
    return [n for n, kind in df.dtypes if kind == "string" and n not in NOT_ENCODED]


@dataclass(frozen=True)
class CategoricalEncoder:
    """One-hot columns for a few levels, codes in sorted order for many.

    ``levels`` holds at most ten values per column; ``codes`` are stored tables.
    """

    levels: dict[str, list[str]] = field(default_factory=dict)
    codes: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str] | None = None, one_hot: int = ONE_HOT_LEVELS):
        """One pass gives the distinct (column, level) pairs, combined before the shuffle;
        levels are counted and coded from those. ``one_hot=0`` codes all columns."""
        chosen = categorical_columns(df) if columns is None else columns
        if not chosen:
            return cls()
        cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("level")) for c in chosen])
        pairs = stage_table(df.select(F.inline(cells)).distinct(), "levels")
        counts = {r["variable"]: r["n"] for r in pairs.groupBy("variable").agg(F.count("level").alias("n")).collect()}
        few = [c for c in chosen if counts.get(c, 0) <= one_hot]
        levels: dict[str, list[str]] = {c: [] for c in few}
        if few:
            # At most ``one_hot`` rows per column.
            known = pairs.where(F.col("variable").isin(few) & F.col("level").isNotNull())
            for row in known.orderBy("variable", "level").collect():
                levels[row["variable"]].append(row["level"])
        codes = {
            c: stage_table(
                dense_codes(
                    pairs.where(F.col("variable") == c).select(F.coalesce("level", F.lit(_MISSING)).alias(c)), c, f"{c}_encoded"
                ),
                "codes",
            )
            for c in chosen
            if c not in few
        }
        return cls(levels, codes)

    def flag_names(self, column: str) -> dict[str | None, str]:
        """One-hot column of each level and of a missing value (None). A dot in a name would
        read as a path into a struct; levels that differ by it only get numbered names."""
        names: dict[str | None, str] = {}
        for value in [None, *self.levels[column]]:
            name = base = f"{column}_{_MISSING if value is None else value.replace('.', '_')}"
            number = 1
            while name in names.values():
                number += 1
                name = f"{base}_{number}"
            names[value] = name
        return names

    def transform(self, df: DataFrame) -> DataFrame:
        """Encoded columns in place of the categorical ones. A level not seen when
        fitting is 0 in every one-hot column and NULL as a code."""
        flags: dict[str, Column] = {}
        for column, values in self.levels.items():
            names = self.flag_names(column)
            for value in values:
                flags[names[value]] = F.coalesce((F.col(column) == value).cast("int"), F.lit(0))
            flags[names[None]] = F.col(column).isNull().cast("int")
        encoded = df.withColumns(flags).drop(*self.levels) if flags else df
        for column, table in self.codes.items():
            encoded = (
                encoded.withColumn(column, F.coalesce(column, F.lit(_MISSING)))
                .join(table, column, "left")
                .drop(column)
            )
        return encoded


def encoded_by(
    df: DataFrame, key: str, groups: Sequence, columns: list[str] | None = None, one_hot: int = ONE_HOT_LEVELS
) -> DataFrame:
    """Each of the few ``groups`` of ``key`` encoded on its own, put together over all columns: a flag that a group does
    not have is 0 in its rows. ``df`` is read once a group and once more for its levels: pass a stored table."""
    parts = [df.where(F.col(key) == group) for group in groups]
    return combine([CategoricalEncoder.fit(p, columns, one_hot).transform(p) for p in parts], common_only=False)


@dataclass(frozen=True)
class Scaler:
    """(x - centre) / width per column."""

    centre: dict[str, float]
    width: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(f"`{c}`") - F.lit(self.centre[c])) / F.lit(self.width[c])
                for c in self.centre
            }
        )


def robust_scaler(train: DataFrame, columns: list[str]) -> Scaler:
    """Median and exact interquartile range of the training rows; a range of 0 counts
    as 1."""
    quartiles = column_quantiles(train, columns, (0.25, 0.5, 0.75))
    return Scaler(
        {c: q[1] for c, q in quartiles.items()},
        {c: (q[2] - q[0]) or 1.0 for c, q in quartiles.items()},
    )


def standard_scaler(train: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population deviation of the training rows; 0 counts as 1."""
    row = train.agg(
        *[F.avg(f"`{c}`").alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(f"`{c}`").alias(f"s_{c}") for c in columns],
    ).first()
    return Scaler(
        {c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns}
    )


def scaled_by(df: DataFrame, train: DataFrame, key: str, columns: Sequence[str], robust: bool = True) -> DataFrame:
    """``df`` with its columns scaled by the figures of the training rows of the row's own ``key``, all groups in one pass:
    median and interquartile range, or mean and population deviation; a width of 0 counts as 1. A group
    without training rows gets NULL."""
    figures = summarize(train, [key], columns, (0.25, 0.5, 0.75) if robust else ())
    centre, width = (F.col("p50"), F.col("p75") - F.col("p25")) if robust else (F.col("mean"), F.col("std_pop"))
    wanted = {}
    for i, column in enumerate(columns):
        wanted[f"_centre_{i}"], wanted[f"_width_{i}"] = (column, centre), (column, width)
    joined = df.join(stage_table(spread(figures, [key], wanted), "scales"), key, "left")
    scaled = {
        c: (F.col(f"`{c}`") - F.col(f"_centre_{i}")) / F.when(F.col(f"_width_{i}") == 0, 1.0).otherwise(F.col(f"_width_{i}"))
        for i, c in enumerate(columns)
    }
    return joined.withColumns(scaled).drop(*wanted)
