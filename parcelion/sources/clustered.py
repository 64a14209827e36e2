"""Silver clustered by month and postal code, with a name index: filters read the files that hold an answer.

Rows are ordered by the interleaved bits of their month's and their postal code's place among all months and codes, and cut into ranges of like
size, so that a file covers few months of few codes. The smallest and largest values of each file are stored beside it; a
filter reads that list first, one row per file, and then only the files whose span it meets.

The name index holds every distinct (commune, postal code) and, for each, the runs of three characters of the lower-cased name. A text sought
in a name must have its runs there, so names come from the runs they share, then from the pattern itself, and rows from the files
of their postal codes. ``%`` and ``_`` are wildcards; a text without a run of three characters is held against all names, not all rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.operators.gold import dense_codes
from parcelion.schemas import SILVER
from parcelion.session import stage_table

LEVEL_BITS = 10
RUN = 3


def interleaved(first: Column, second: Column, bits: int = LEVEL_BITS) -> Column:
    """The bits of two numbers in turn, those of ``first`` higher."""
    found = F.lit(0)
    for i in range(bits):
        found = found + F.shiftleft(F.shiftright(first, i).bitwiseAND(F.lit(1)), 2 * i + 1) + F.shiftleft(F.shiftright(second, i).bitwiseAND(F.lit(1)), 2 * i)
    return found


def _levels(values: DataFrame, name: str, level: str) -> DataFrame:
    """(name, level): the place of each distinct value among all, on 2 to the power of LEVEL_BITS levels."""
    codes = stage_table(dense_codes(values.where(F.col(name).isNotNull()), name, "_code"), "levels")
    size = codes.agg(F.count(F.lit(1))).first()[0]
    return codes.select(name, F.floor(F.col("_code") * 2**LEVEL_BITS / max(size, 1)).cast("int").alias(level))


def runs(text: Column) -> Column:
    """Distinct runs of three characters."""
    last = F.char_length(text) - RUN + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(RUN))))).otherwise(
        F.array().cast("array<string>")
    )


@dataclass(frozen=True)
class ClusteredSilver:
    """Silver, its file spans and its name index below ``path``. ``derived`` columns follow from the others: they are not stored but computed
    when rows are read."""

    spark: SparkSession
    path: str
    derived: dict[str, Column] | None = None

    def _stored(self, *files: str) -> DataFrame:
        kept = [field for field in SILVER.fields if field.name not in (self.derived or {})]
        return self.spark.read.schema(T.StructType(kept)).parquet(*files)

    def _rows(self, *files: str) -> DataFrame:
        return self._stored(*files).withColumns(self.derived or {}).select(*SILVER.fieldNames())

    def build(self, silver: DataFrame, files: int) -> None:
        """Store ``silver`` (a stored table) in about ``files`` files."""
        rows = silver.withColumn("_month", F.date_trunc("month", "date_mutation").cast("date"))
        months, codes = _levels(rows, "_month", "_m"), _levels(rows, "code_postal", "_c")
        placed = rows.join(months, "_month", "left").join(codes, "code_postal", "left")
        key = interleaved(F.coalesce("_m", F.lit(0)), F.coalesce("_c", F.lit(0)))
        # Levels are small tables, so the rows are placed again for the ranges' sample rather than written.
        placed = placed.withColumn("_z", key)
        kept = [c for c in SILVER.fieldNames() if c not in (self.derived or {})]
        # The key, or what tells most rows apart without it.
        order = ["_z", "code_postal", "date_mutation", *(["id_unique"] if "id_unique" in kept else ["valeur_fonciere", "surface_reelle_bati"])]
        placed.repartitionByRange(files, *order).sortWithinPartitions(*order).select(*kept).write.mode("overwrite").parquet(f"{self.path}/rows")
        stored = self._stored(f"{self.path}/rows")
        spans = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in ("date_mutation", "code_postal") for n, f in (("low", F.min), ("high", F.max))]
        )
        spans.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/spans")
        silver.where(F.col("commune").isNotNull()).select("commune", "code_postal").distinct().write.mode("overwrite").parquet(f"{self.path}/names")
        names = self.spark.read.schema("commune string, code_postal string").parquet(f"{self.path}/names")
        postings = names.select("commune").distinct().select("commune", F.explode(runs(F.lower("commune"))).alias("run"))
        postings.repartitionByRange("run").sortWithinPartitions("run").write.mode("overwrite").parquet(f"{self.path}/runs")

    def files(self, postal_codes: list[str] | None = None, start: str | None = None, end: str | None = None) -> list[str]:
        """Files that may hold rows of one of the postal codes, dated in [start, end)."""
        spans = self.spark.read.parquet(f"{self.path}/spans")
        if postal_codes is not None and not postal_codes:
            return []
        if postal_codes is not None:
            spans = spans.where(F.exists(F.array(*[F.lit(c) for c in postal_codes]), lambda c: c.between(F.col("low_code_postal"), F.col("high_code_postal"))))
        if start is not None:
            spans = spans.where(F.col("high_date_mutation") >= F.to_date(F.lit(start)))
        if end is not None:
            spans = spans.where(F.col("low_date_mutation") < F.to_date(F.lit(end)))
        return [r.file for r in spans.select("file").collect()]

    def read(self, postal_codes: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
        found = self.files(postal_codes, start, end)
        if not found:
            return self.spark.createDataFrame([], SILVER)
        rows, day = self._rows(*found), F.col("date_mutation")
        if postal_codes is not None:
            rows = rows.where(F.col("code_postal").isin(postal_codes))
        if start is not None:
            rows = rows.where(day >= F.to_date(F.lit(start)))
        return rows if end is None else rows.where(day < F.to_date(F.lit(end)))

    def names(self, text: str) -> DataFrame:
        """(commune, code_postal) whose name contains ``text`` in any case."""
        pieces = [p for p in re.split(r"[%_]", text) if len(p) >= RUN]
        names = self.spark.read.parquet(f"{self.path}/names")
        if pieces:
            wanted = sorted({p[i : i + RUN] for p in pieces for i in range(len(p) - RUN + 1)})
            # Each run is lower-cased by the engine that lower-cased the names.
            lowered = F.array(*[F.lower(F.lit(w)) for w in wanted])
            postings = self.spark.read.parquet(f"{self.path}/runs").where(F.array_contains(lowered, F.col("run")))
            whole = postings.groupBy("commune").agg(F.count_distinct("run").alias("found")).where(F.col("found") == F.size(F.array_distinct(lowered)))
            names = names.join(whole, "commune", "left_semi")
        return names.where(F.col("commune").ilike(f"%{text}%"))

    def lookup(self, postal_code: str | None = None, commune: str | None = None, rows: int = 100) -> DataFrame:
        """What a scan of all rows gives for the same filters: the first rows by content key."""
        if not commune:
            found = self.read([postal_code] if postal_code else None)
            return found.orderBy("id_unique").limit(rows)
        names = self.names(commune)
        names = stage_table(names.where(F.col("code_postal") == postal_code) if postal_code else names, "names")
        codes = [r.code_postal for r in names.select("code_postal").distinct().collect()]
        if None in codes:
            # Rows without a postal code lie in no span of codes.
            found = self._rows(f"{self.path}/rows")
        else:
            found = self.read(codes)
        # A name has rows under other codes as well: with a postal code only those of that code count.
        if postal_code:
            found = found.where(F.col("code_postal") == postal_code)
        return found.join(names.select("commune").distinct(), "commune", "left_semi").select(*SILVER.fieldNames()).orderBy("id_unique").limit(rows)
