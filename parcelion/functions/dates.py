"""Date column helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """``dd/MM/yyyy`` text to a date, NULL when it is none."""
    return F.try_to_date(text, "dd/MM/yyyy")


def calendar_features(day: Column) -> dict[str, Column]:
    """Year, month, quarter, weekday (Monday 0) and day of year."""
    return {
        "annee": F.year(day),
        "mois": F.month(day),
        "trimestre": F.quarter(day),
        "jour_semaine": F.weekday(day),
        "jour_annee": F.dayofyear(day),
    }


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of ``value`` on a circle of ``period`` steps."""
    angle = 2 * math.pi * value / period
    return F.sin(angle), F.cos(angle)


def date_parts(day: Column) -> dict[str, Column]:
    """Numeric parts that stand in for a date column, with epoch seconds."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.day(day),
        "dayofweek": F.weekday(day),
        "quarter": F.quarter(day),
        "timestamp": F.unix_date(day).cast("long") * 86_400,
    }


def move_to_year(day: Column, year: int) -> Column:
    """Same day and month in ``year``; 29 February becomes the 28th."""
    return F.add_months(day, (F.lit(year) - F.year(day)) * 12)


def local_clock(instant: Column, zone: str = "Europe/Paris") -> Column:
    """Instant as wall-clock text in ``zone``, whatever the session's own zone is."""
    here = instant.cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(None, F.lit(zone), here), "yyyy-MM-dd HH:mm:ss")
