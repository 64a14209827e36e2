"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(text: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def department(postal_code: Column) -> Column:
    """First two characters of the five-digit postal code; NULL stays NULL."""
    return F.substring(zero_pad(postal_code, 5), 1, 2)


def source_tag(file_name: Column) -> Column:
    """File name without its ``.txt`` ending."""
    return F.regexp_replace(file_name, r"\.txt$", "")


def blank_to(text: Column, default: str) -> Column:
    """Default for NULL and empty text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def ranked_label(name: Column, count: Column) -> Column:
    """``NAME (12)``; a missing name reads ``None`` so the entry keeps its count."""
    return F.concat(F.coalesce(name, F.lit("None")), F.lit(" ("), count.cast("string"), F.lit(")"))


def split_label(label: Column) -> tuple[Column, Column]:
    """Name and count of a ``NAME (12)`` label, split at the last opening bracket."""
    name = F.regexp_extract(label, r"^(.*) \((.*?)\)*$", 1)
    count = F.regexp_extract(label, r"^(.*) \((.*?)\)*$", 2).try_cast("long")
    return name, count


def row_key(columns: list[str]) -> Column:
    """SHA-256 hex of the columns joined by ``||``; NULLs are left out of the text."""
    return F.sha2(F.concat_ws("||", *[F.col(c).cast("string") for c in columns]), 256)


def hex_decile(digest: Column, start: int = 1) -> Column:
    """0..9 from four hex digits of a digest: a split that never changes for a row."""
    number = F.conv(F.substring(digest, start, 4), 16, 10).cast("int")
    return F.floor(number * 10 / 65536).cast("int")
