"""Exact distribution figures without ordering or collecting whole groups.

``percentile`` keeps every value of a group in one buffer, and a price segment or a
large department may hold a third of all rows. Here a first scan counts rows per
(group, bin): the counts are combined before the shuffle, so a few thousand rows per
task travel, however large a group is. Running counts tell which bin holds a quantile
position. A wanted bin that still holds more than ``CELL_ROWS`` rows is cut again between its own
smallest and largest value, as often as it takes, and the last scan orders only the values of
the cells that remain: a bin of 32-bit values needs one cut at most, near-equal doubles a few.

The input is scanned twice or more: pass a stored table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelion.functions.numeric import equal_width_bin, with_ordered_bin
from parcelion.session import stage_table

QUARTILES = (0.25, 0.5, 0.75)
# Rows that may be ordered in one task, and the parts a larger cell is cut into.
CELL_ROWS, PARTS = 1 << 17, 4096


def quantile_name(q: float) -> str:
    return f"p{round(q * 100)}"


def cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows (keys, variable, value). NULL keys and missing values are left out."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in columns
        ]
    )
    usable = F.col("value").isNotNull() & ~F.isnan("value")
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return df.select(*keys, F.inline(pairs)).where(usable)


def _binned(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Size, range and power sums of each bin, around the bin's own edge."""
    off = F.col("off")
    return (
        rows.withColumn("off", F.col("value") - F.col("edge"))
        .groupBy(*group, "bin", "edge")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.sum(off).alias("s1"),
            F.sum(off * off).alias("s2"),
            F.sum(off * off * off).alias("s3"),
        )
    )


def summarize(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], quantiles: Sequence[float] = (0.5,)
) -> DataFrame:
    """Per (keys, variable): n, mean, std, std_pop, skew, min, max and exact quantiles
    with linear interpolation, as columns ``p25``, ``p50`` and so on.

    ``std`` is the sample deviation, ``skew`` the population one.
    """
    group = [*keys, "variable"]
    rows = with_ordered_bin(cells(df, keys, columns), "value")
    bins = _with_moments(_binned(rows, group), group)
    if quantiles:
        picked = _values_at(rows, bins, group, quantiles)
    else:
        picked = bins.groupBy(*group).agg(*[F.max(c).alias(c) for c in _MOMENTS])
    n, m2, m3 = F.col("n"), F.col("m2"), F.col("m3")
    return picked.select(
        *group,
        "n",
        "mean",
        F.sqrt(F.try_divide(m2, n - 1)).alias("std"),
        F.sqrt(m2 / n).alias("std_pop"),
        F.try_divide(m3 / n, F.pow(m2 / n, F.lit(1.5))).alias("skew"),
        "min",
        "max",
        *[_interpolated(i, q).alias(quantile_name(q)) for i, q in enumerate(quantiles)],
    )


_MOMENTS = ["n", "mean", "m2", "m3", "min", "max"]


def _with_moments(bins: DataFrame, group: Sequence[str]) -> DataFrame:
    """Each bin with the figures of its whole group and the rows before and until it."""
    whole = Window.partitionBy(*group)
    up_to = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge, size, s1, s2, s3 = (F.col(c) for c in ("edge", "size", "s1", "s2", "s3"))
    located = bins.withColumns(
        {
            "n": F.sum(size).over(whole),
            "mean": F.sum(size * edge + s1).over(whole) / F.sum(size).over(whole),
            "min": F.min("low").over(whole),
            "max": F.max("high").over(whole),
        }
    )
    d = F.col("_d")
    return located.withColumn("_d", edge - F.col("mean")).withColumns(
        {
            "m2": F.sum(s2 + 2 * d * s1 + size * d * d).over(whole),
            "m3": F.sum(s3 + 3 * d * s2 + 3 * d * d * s1 + size * d * d * d).over(whole),
            "until": F.sum(size).over(up_to),
        }
    ).withColumn("before", F.col("until") - size)


def _within(rows: DataFrame, wanted: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows whose value lies in a wanted cell, with the cell's range."""
    found = rows.join(wanted.select(*group, "bin", "low", "high", "size"), [*group, "bin"])
    return found.where(F.col("value").between(F.col("low"), F.col("high")))


def _cut_again(rows: DataFrame, wanted: DataFrame, group: Sequence[str]) -> DataFrame:
    """The wanted cells cut into parts of equal width; the parts that hold a position."""
    cell = [*group, "bin", "low"]
    half = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
    small = (F.col("size") <= CELL_ROWS) | (F.col("low") == F.col("high"))
    part = F.when(small, 0).otherwise(F.least(F.floor(half * PARTS), F.lit(PARTS - 1)))
    parts = _within(rows, wanted, group).groupBy(*cell, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_size"), F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    up_to = Window.partitionBy(*cell).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.col("before") + F.col("_until")
    held = F.filter("ranks", lambda r: (r["rank"] >= until - F.col("_size")) & (r["rank"] < until))
    located = parts.withColumn("_until", F.sum("_size").over(up_to)).join(wanted, cell)
    return located.withColumn("_held", held).where(F.size("_held") > 0).select(
        *group, "bin", F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_size").alias("size"),
        (until - F.col("_size")).alias("before"), F.col("_held").alias("ranks"), *_MOMENTS,
    )


def _place(q: float) -> Column:
    return (F.col("n") - 1) * q


def _interpolated(i: int, q: float) -> Column:
    part = _place(q) - F.floor(_place(q))
    lower, upper = F.col(f"_lower{i}"), F.col(f"_upper{i}")
    return F.when(part == 0, lower).otherwise(lower + (upper - lower) * part)


def _located(rows: DataFrame, bins: DataFrame, group: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """The two values next to every quantile position: group, figures, ``value`` and ``hit`` with its slot.

    The wanted cells, a few per group, are stored: their true size decides whether they
    are broadcast to the next scan. Inside a cell, values are counted before they are
    ordered.
    """
    ranks = []
    for i, q in enumerate(quantiles):
        for side, rank in (("lower", F.floor(_place(q))), ("upper", F.ceil(_place(q)))):
            slot = F.lit(f"_{side}{i}").alias("slot")
            ranks.append(F.struct(slot, rank.cast("long").alias("rank")))
    wanted = stage_table(
        bins.withColumn(
            "ranks",
            F.filter(
                F.array(*ranks),
                lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("until")),
            ),
        )
        .where(F.size("ranks") > 0)
        .select(*group, "bin", "low", "high", "size", "before", "ranks", *_MOMENTS),
        "bins",
    )
    place = [*group, "bin", "low"]
    while (wanted.where("low < high").agg(F.max("size")).first()[0] or 0) > CELL_ROWS:
        wanted = stage_table(_cut_again(rows, wanted, group), "bins")
    counted = (
        _within(rows, wanted, group)
        .groupBy(*place, "value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    inside = Window.partitionBy(*place).orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hits = F.filter(
        "ranks",
        lambda r: (r["rank"] >= F.col("until") - F.col("_rows")) & (r["rank"] < F.col("until")),
    )
    return (
        counted.withColumn("_run", F.sum("_rows").over(inside))
        .join(wanted, place)
        .withColumn("until", F.col("before") + F.col("_run"))
        .withColumn("hit", F.explode(hits))
    )


def _values_at(
    rows: DataFrame, bins: DataFrame, group: Sequence[str], quantiles: Sequence[float]
) -> DataFrame:
    """Group figures with the two values next to every quantile position."""
    slots = [f"_{side}{i}" for i in range(len(quantiles)) for side in ("lower", "upper")]
    return _located(rows, bins, group, quantiles).groupBy(*group).agg(
        *[F.max(c).alias(c) for c in _MOMENTS],
        *[F.max(F.when(F.col("hit.slot") == s, F.col("value"))).alias(s) for s in slots],
    )


def column_places(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of whole columns, however many: as those of :func:`summarize`, in one count of bins and one scan of their values.
    The driver sees two values per column and quantile."""
    rows = with_ordered_bin(cells(df, [], columns), "value")
    group = ["variable"]
    found: dict[str, dict[str, float]] = {}
    sizes: dict[str, int] = {}
    for row in _located(rows, _with_moments(_binned(rows, group), group), group, quantiles).select("variable", "n", "hit.slot", "value").collect():
        sizes[row["variable"]] = row["n"]
        found.setdefault(row["variable"], {})[row["slot"]] = row["value"]
    out = {}
    for column, values in found.items():
        places = [(sizes[column] - 1) * q for q in quantiles]
        ends = [(values[f"_lower{i}"], values[f"_upper{i}"], place - math.floor(place)) for i, place in enumerate(places)]
        out[column] = [lower if part == 0 else lower + (upper - lower) * part for lower, upper, part in ends]
    return out


def spread(summary: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row per key from the one-row-per-variable summary: output name to
    (variable, expression over the summary columns)."""
    cells = [
        F.max(F.when(F.col("variable") == variable, expression)).alias(name)
        for name, (variable, expression) in wanted.items()
    ]
    return summary.groupBy(*keys).agg(*cells) if keys else summary.agg(*cells)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    return summarize(df, [], columns, QUARTILES).select(
        "variable", F.col("n").alias("count"), "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def histogram(df: DataFrame, keys: Sequence[str], column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins between each group's smallest and largest
    value. Empty bins have no row.

    Extents, one row per group, are stored and joined back by their true size.
    """
    group = [*keys, "variable"]
    rows = cells(df, keys, [column])
    extents = stage_table(
        rows.groupBy(*group).agg(F.min("value").alias("low"), F.max("value").alias("high")),
        "extents",
    )
    index = equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins)
    return (
        rows.join(extents, group)
        .groupBy(*keys, index.alias("classe"))
        .agg(
            F.min("low").alias("borne_min"),
            F.max("high").alias("borne_max"),
            F.count(F.lit(1)).alias("effectif"),
        )
    )


def box_plot(df: DataFrame, keys: Sequence[str], column: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the furthest value inside ``factor`` times the
    interquartile range, and the number of values outside."""
    group = [*keys, "variable"]
    reach = factor * (F.col("p75") - F.col("p25"))
    fences = stage_table(
        summarize(df, keys, [column], QUARTILES).select(
            *group, "n", "p25", "p50", "p75",
            (F.col("p25") - reach).alias("fence_low"), (F.col("p75") + reach).alias("fence_high"),
        ),
        "fences",
    )
    inside = (F.col("value") >= F.col("fence_low")) & (F.col("value") <= F.col("fence_high"))
    drawn = cells(df, keys, [column]).join(fences, group).groupBy(*group).agg(
        *[F.max(c).alias(c) for c in ("n", "p25", "p50", "p75")],
        F.min(F.when(inside, F.col("value"))).alias("low"),
        F.max(F.when(inside, F.col("value"))).alias("high"),
        F.count_if(~inside).alias("hors"),
    )
    # With few values no value may lie between a fence and its quartile.
    return drawn.select(
        *keys,
        "n",
        F.col("p25").alias("q1"),
        F.col("p50").alias("mediane"),
        F.col("p75").alias("q3"),
        F.least(F.coalesce("low", "p25"), F.col("p25")).alias("moustache_basse"),
        F.greatest(F.coalesce("high", "p75"), F.col("p75")).alias("moustache_haute"),
        "hors",
    )


def exact_sample(df: DataFrame, keys: Sequence[str], identity: str, rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows per group (or all, if there are fewer), chosen by a salted
    digest of ``identity``: the same rows on every run and partitioning.

    A first scan counts rows per five-digit digest prefix (at most 2^20 per group);
    running sums give the last prefix that is needed. A second scan keeps the rows up to
    that prefix, and only those are ordered. Pass a stored table.
    """
    group = list(keys)
    # Without keys all rows belong to one group.
    same = group or [F.lit(0)]
    tagged = df.withColumn(
        "_digest", F.sha2(F.concat(F.col(identity), F.lit(f":{seed}")), 256)
    ).withColumn("_prefix", F.substring("_digest", 1, 5))
    earlier = Window.partitionBy(*same).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        tagged.groupBy(*group, "_prefix")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .where(F.col("_before") < rows)
    )
    if group:
        last = needed.groupBy(*group).agg(F.max("_prefix").alias("_last"))
        near = tagged.join(stage_table(last, "prefixes"), group).where(F.col("_prefix") <= F.col("_last"))
    else:
        near = tagged.where(F.col("_prefix") <= F.lit(needed.agg(F.max("_prefix")).first()[0]))
    ordered = Window.partitionBy(*same).orderBy("_digest", identity)
    return (
        near.withColumn("_place", F.row_number().over(ordered))
        .where(F.col("_place") <= rows)
        .select(*df.columns)
    )


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group with the two ends it is drawn
    between. The sums are combined before the shuffle."""
    fitted = df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("pente"),
        F.regr_intercept(y, x).alias("ordonnee"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )
    ends = {
        f"y_{end}": F.col("pente") * F.col(f"x_{end}") + F.col("ordonnee") for end in ("min", "max")
    }
    return fitted.withColumns(ends)
