"""Month tables that are written, audited and then published.

A load writes its months to a folder of its own, its rules are checked on what was written, and only then does a new list of months
take effect: one small file that names the folder of every month, put in place by a rename. Readers follow the newest list, so they see a load whole or not at
all. A load replaces every month of its window, and a month that it has no rows for disappears. A load that breaks a rule is refused
and its folder deleted; the table stays as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import path_exists


class Refused(ValueError):
    """A load that breaks rules; ``violations`` tells how often by rule."""

    def __init__(self, violations: dict[str, int]):
        super().__init__(f"load refused: {violations}")
        self.violations = violations


@dataclass(frozen=True)
class MonthTable:
    """A table of dated rows below ``path``; months are numbered as year * 100 + month."""

    spark: SparkSession
    path: str
    schema: T.StructType
    day: str = "date_mutation"

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _lists(self) -> list[int]:
        if not path_exists(self.spark, f"{self.path}/lists"):
            return []
        fs, place = self._fs(f"{self.path}/lists")
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(n) for n in names if n.isdigit())

    def months(self) -> dict[int, str]:
        """The published months and the load that holds each: one entry per month."""
        lists = self._lists()
        if not lists:
            return {}
        told = self.spark.read.text(f"{self.path}/lists/{lists[-1]}", wholetext=True).first().value
        return {int(month): load for month, load in json.loads(told).items()}

    def read(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Published rows of the months ``first`` to ``last``; other folders are not listed."""
        wanted = {m: load for m, load in self.months().items() if (first is None or m >= first) and (last is None or m <= last)}
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{load}/mois={month}" for month, load in sorted(wanted.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _publish(self, months: dict[int, str], number: int) -> None:
        """Put list ``number`` in place. Another load that took the number first makes this one fail."""
        fs, target = self._fs(f"{self.path}/lists/{number}")
        _, draft = self._fs(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps({str(m): load for m, load in sorted(months.items())}).encode())
        out.close()
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"another load published list {number} of {self.path}")

    def load(self, rows: DataFrame, first: int, last: int, rules: Callable[[DataFrame], dict[str, int]] = lambda rows: {}) -> dict[int, str]:
        """Replace the months ``first`` to ``last`` by ``rows`` (those dated in them) and publish. ``rules`` counts violations by name in
        the rows as they were written."""
        lists, load = self._lists(), f"load-{uuid.uuid4().hex}"
        month = F.year(self.day) * 100 + F.month(self.day)
        chosen = rows.select(*self.schema.fieldNames(), month.alias("mois")).where(F.col("mois").between(first, last))
        chosen.hint("rebalance", "mois").write.partitionBy("mois").parquet(f"{self.path}/{load}")
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("mois", T.IntegerType())])).parquet(f"{self.path}/{load}")
        broken = {rule: n for rule, n in rules(written.drop("mois")).items() if n}
        if broken:
            fs, place = self._fs(f"{self.path}/{load}")
            fs.delete(place, True)
            raise Refused(broken)
        fresh = {r.mois: load for r in written.select("mois").distinct().collect()}
        kept = {m: held for m, held in self.months().items() if not first <= m <= last}
        self._publish(kept | fresh, (lists[-1] if lists else 0) + 1)
        return kept | fresh

    def changed(self, before: dict[int, str]) -> tuple[DataFrame, DataFrame, list[int]]:
        """Rows of the months that differ from an earlier list: as they were, as they are, and the months."""
        now = self.months()
        months = sorted(m for m in before.keys() | now.keys() if before.get(m) != now.get(m))

        def rows(held: dict[int, str]) -> DataFrame:
            paths = [f"{self.path}/{held[m]}/mois={m}" for m in months if m in held]
            return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

        return rows(before), rows(now), months


def key_rules(key: list[str], required: list[str] = (), references: dict[str, DataFrame] | None = None) -> Callable[[DataFrame], dict[str, int]]:
    """Rules of a load: ``key`` occurs once, ``required`` columns are there, every value of a column of ``references`` is in its table."""

    def check(rows: DataFrame) -> dict[str, int]:
        doubles = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("n")).first().n
        found = {f"{', '.join(key)} unique": doubles}
        if required:
            gaps = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
            found |= {f"{c} not null": gaps[c] for c in required}
        for column, table in (references or {}).items():
            used = rows.select(column).where(F.col(column).isNotNull()).distinct()
            found[f"{column} exists"] = used.join(table.select(column).distinct(), column, "left_anti").count()
        return found

    return check
