"""Figures of groups learnt without one fold, for every fold in two scans.

Counts, means and squared deviations of each (group, fold) are one aggregate, and the state without a fold is the group's state less
the fold's. Medians come from count tables: rows are counted per (group, fold, value bin), the table without a fold is the whole
less that fold's column, and it tells the bin of the middle rows; a second scan counts the values of those bins only. Bins depend on
the value alone, so what travels is bins by folds and not rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelion.functions.numeric import with_ordered_bin
from parcelion.session import stage_table


def fold_states(rows: DataFrame, keys: Sequence[str], fold: str, columns: Sequence[str]) -> DataFrame:
    """(keys, fold, n_c, mean_c, m2_c) of every column c."""
    figures = []
    for c in columns:
        value = F.col(c).cast("double")
        figures += [F.count(value).alias(f"n_{c}"), F.avg(value).alias(f"mean_{c}"), (F.var_pop(value) * F.count(value)).alias(f"m2_{c}")]
    return rows.groupBy(*keys, fold).agg(*figures)


def without_fold(states: DataFrame, keys: Sequence[str], fold: str, folds: int, columns: Sequence[str]) -> DataFrame:
    """(keys, held, n_c, mean_c, std_c): the figures of all folds but ``held``; NULL where nothing is left. One row of a group holds the
    states of all its folds."""
    wide = states.groupBy(*keys).pivot(fold, list(range(folds))).agg(*[F.first(f"{p}_{c}").alias(f"{p}_{c}") for c in columns for p in ("n", "mean", "m2")])
    out = []
    for held in range(folds):
        told = [F.lit(held).alias("held")]
        for c in columns:
            n, mean, m2 = _merged(c, [f for f in range(folds) if f != held])
            told += [n.alias(f"n_{c}"), mean.alias(f"mean_{c}"), F.sqrt(F.try_divide(m2, n - 1)).alias(f"std_{c}")]
        out.append(F.struct(*told))
    return wide.select(*keys, F.inline(F.array(*out)))


def _merged(column: str, folds: Sequence[int]) -> tuple[Column, Column, Column]:
    """Count, mean and squared deviation of several folds' states."""
    state = lambda p, f: F.coalesce(F.col(f"`{f}_{p}_{column}`"), F.lit(0))
    n = reduce(lambda a, b: a + b, [state("n", f) for f in folds])
    mean = F.try_divide(reduce(lambda a, b: a + b, [state("n", f) * state("mean", f) for f in folds]), n)
    m2 = reduce(lambda a, b: a + b, [state("m2", f) + state("n", f) * (state("mean", f) - mean) * (state("mean", f) - mean) for f in folds])
    return n, mean, m2


def fold_medians(rows: DataFrame, keys: Sequence[str], fold: str, folds: int, column: str) -> DataFrame:
    """(keys, held, median): the exact median of all folds but ``held``. ``rows`` are read twice."""
    chosen = rows.select(*keys, F.col(fold).alias("_fold"), F.col(column).cast("double").alias("_value"))
    binned = with_ordered_bin(chosen.where(F.col("_value").isNotNull() & ~F.isnan("_value")), "_value", "_bin", "_edge")
    counts = binned.groupBy(*keys, "_bin").agg(*[F.count_if(F.col("_fold") == f).alias(f"_f{f}") for f in range(folds)])
    whole = reduce(lambda a, b: a + b, [F.col(f"_f{f}") for f in range(folds)])
    less = F.array(*[F.struct(F.lit(f).alias("held"), (whole - F.col(f"_f{f}")).alias("_n")) for f in range(folds)])
    # The table of a group without a fold: a row per bin, of which there are a few thousand.
    table = counts.select(*keys, "_bin", F.inline(less)).where(F.col("_n") > 0)
    group = Window.partitionBy(*keys, "held")
    table = table.withColumns({"_until": F.sum("_n").over(group.orderBy("_bin")), "_all": F.sum("_n").over(group)})
    low, high = F.floor((F.col("_all") - 1) / 2), F.ceil((F.col("_all") - 1) / 2)
    before = F.col("_until") - F.col("_n")
    wanted = stage_table(
        table.where((F.col("_until") > low) & (before <= high)).select(*keys, "held", "_bin", before.alias("_before"), low.alias("_low"), high.alias("_high")), "middle"
    )
    values = binned.join(wanted, [*keys, "_bin"]).where(F.col("_fold") != F.col("held"))
    values = values.groupBy(*keys, "held", "_bin", "_before", "_low", "_high", "_value").agg(F.count(F.lit(1)).alias("_n"))
    until = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "held", "_bin").orderBy("_value"))
    placed = values.withColumn("_until", until)
    at = lambda place: F.max(F.when((F.col("_until") > place) & (F.col("_until") - F.col("_n") <= place), F.col("_value")))
    return placed.groupBy(*keys, "held").agg(((at(F.col("_low")) + at(F.col("_high"))) / 2).alias("median"))


def department_folds(train: DataFrame, keys: Sequence[str], fold: str = "pli", folds: int = 5, price: str = "valeur_fonciere", surface: str = "surface_reelle_bati") -> DataFrame:
    """(keys, held, dept_mean_price, dept_median_price, dept_std_price, dept_count_trans, dept_mean_surface): the department figures a row of
    fold ``held`` may know. ``train`` is stored."""
    states = fold_states(train, keys, fold, [price, surface])
    moments = without_fold(states, keys, fold, folds, [price, surface]).where(F.col(f"n_{price}") > 0)
    medians = fold_medians(train, keys, fold, folds, price)
    return moments.join(medians, [*keys, "held"]).select(
        *keys, "held", F.col(f"mean_{price}").alias("dept_mean_price"), F.col("median").alias("dept_median_price"),
        F.col(f"std_{price}").alias("dept_std_price"), F.col(f"n_{price}").alias("dept_count_trans"), F.col(f"mean_{surface}").alias("dept_mean_surface"),
    )
