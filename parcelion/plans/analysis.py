"""Whole flows over silver: segment preparation and the projection study."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.operators import features, models
from parcelion.operators.encode import CategoricalEncoder, Scaler, robust_scaler
from parcelion.session import stage_table

# Columns that are no features once the categories are encoded.
_PLAIN = ("date_mutation", "commune", "code_postal", "segment")


@dataclass(frozen=True)
class Prepared:
    """One segment ready for learning: scaled lots and what they were fitted with."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    columns: list[str]
    scaler: Scaler
    log_target: bool

    def lots(self) -> dict[str, DataFrame]:
        return {"train": self.train, "val": self.val, "test": self.test}


def prepare(segment: DataFrame, leak_free: bool = True) -> Prepared:
    """Features, encoding, complete rows, lots, scaling learnt on the training lot.

    ``segment`` is a stored table of cleaned silver rows. Features that know the price
    are left out unless ``leak_free`` is turned off.
    """
    built = models.with_lot(features.engineered(segment))
    if leak_free:
        built = features.leak_free(built)
    rows = stage_table(built.withColumn("part_date", F.col("part_date").cast("string")), "features")
    categories = [c for c in features.text_columns(rows) if c not in ("id_unique", "lot", "commune", "code_postal")]
    encoded = CategoricalEncoder.fit(rows, categories).transform(rows).drop(*_PLAIN)
    columns = models.default_features(encoded)
    whole = stage_table(features.complete_rows(encoded, columns), "encoded")
    train, val, test = models.lots(whole)
    # One-hot flags keep their 0 and 1.
    measured = [c for c in columns if c in rows.columns or c.endswith("_encoded")]
    scaler = robust_scaler(train, measured)
    return Prepared(
        *(scaler.transform(part) for part in (train, val, test)),
        columns, scaler, models.needs_log(train),
    )


def prepare_all(segmented: DataFrame, numbers: Sequence[int] = (1, 2, 3), leak_free: bool = True) -> list[Prepared]:
    """Each segment of a stored table prepared on its own. Their jobs are independent, so
    they are submitted side by side and fill each other's gaps."""

    def one(number: int) -> Prepared:
        return prepare(segmented.where(F.col("segment") == number), leak_free)

    with ThreadPoolExecutor(len(numbers)) as pool:
        runs = [pool.submit(copy_context().run, one, number) for number in numbers]
        return [run.result() for run in runs]


def combined_lots(prepared: Sequence[Prepared], common_only: bool = True) -> dict[str, DataFrame]:
    """Lots of several segments put together, over common columns or over all with 0."""
    return {
        name: features.combine([p.lots()[name] for p in prepared], common_only)
        for name in ("train", "val", "test")
    }


def study(segment: DataFrame, year: int = 2025, learner=None) -> DataFrame:
    """Predicted prices of a stored segment moved to ``year``, learnt on all its training rows."""
    built = stage_table(features.leak_free(models.with_lot(features.engineered(segment))), "features")
    return models.project(built, models.safe_lots(built), year, learner)
