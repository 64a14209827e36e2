"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 64
_EXPONENT_SHIFT = 1100  # lifts the smallest double exponent (-1074) above zero
_INFINITE_BIN = 1 << 40


def half_even(value: Column, digits: int = 0) -> Column:
    """Round with ties to even on the double itself; never returns -0.0."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale + F.lit(0.0)


def decimal_comma(text: Column) -> Column:
    """``'249000,00'`` to ``'249000.00'``; empty text to NULL."""
    return F.replace(F.nullif(text, F.lit("")), F.lit(","), F.lit("."))


def single_precision(text: Column) -> Column:
    """Parse as a 32-bit float, NULL on bad text, held as a double with NULL as 0."""
    return F.coalesce(text.try_cast("float"), F.lit(0.0))


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def with_ordered_bin(df: DataFrame, value: str, bin_name: str = "bin", edge_name: str = "edge") -> DataFrame:
    """A bin number that grows with ``value`` and depends on nothing else, and the edge
    of the bin that is nearest to zero.

    Every power of two is cut into 64 equal steps, so a bin holds at most 131,072
    different 32-bit floats. An exponent that is off by one next to a power of two is
    made good by the step, so the order always holds. Zero is bin 0 with edge 0.
    """
    size = F.abs(F.col(value))
    sign, exponent, step = F.signum(value), F.col("_exponent"), F.col("_step")
    number = (exponent + _EXPONENT_SHIFT) * BINS_PER_OCTAVE + step
    edge = F.pow(F.lit(2.0), exponent) * (1 + step / BINS_PER_OCTAVE)
    # Each step is a column of its own, so no expression is written out twice.
    return (
        df.withColumn(
            "_exponent",
            F.when((size > 0) & (size < float("inf")), F.log2(size)).otherwise(0.0),
        )
        .withColumn("_exponent", F.least(F.floor("_exponent"), F.lit(1023)))
        .withColumn("_step", F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * BINS_PER_OCTAVE))
        .withColumns(
            {
                bin_name: F.when(size == 0, F.lit(0).cast("long"))
                .when(size == float("inf"), (sign * _INFINITE_BIN).cast("long"))
                .otherwise(sign.cast("long") * number),
                edge_name: F.when((size == 0) | (size == float("inf")), F.lit(0.0)).otherwise(sign * edge),
            }
        )
        .drop("_exponent", "_step")
    )


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Index 0..bins-1 of equal-width bins, left-closed, the last one closed on both ends.

    The index is moved by one where the value lies on the wrong side of the computed
    edge. A range of no width is widened by 0.5 on each side.
    """
    flat = high == low
    start = F.when(flat, low - 0.5).otherwise(low)
    stop = F.when(flat, high + 0.5).otherwise(high)
    step = (stop - start) / bins
    guess = F.least(F.floor((value - start) / (stop - start) * bins), F.lit(bins - 1))
    below = value < guess * step + start
    above = (guess != bins - 1) & (value >= (guess + 1) * step + start)
    return (guess - below.cast("int") + above.cast("int")).cast("int")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL, not an error, on a zero denominator."""
    return F.try_divide(top, bottom)
