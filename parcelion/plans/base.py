"""The layers every registered query starts from, over one test-data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelion.functions.text import row_key
from parcelion.operators.clean import clean
from parcelion.operators.features import engineered, engineered_by, leak_free
from parcelion.operators.models import with_fold, with_lot
from parcelion.operators.segments import clean_segments
from parcelion.operators.silver import to_silver
from parcelion.schemas import DEDUP_KEY
from parcelion.session import stage_table
from parcelion.sources.testdata import mutations

# Silver holds every year of the tables; the queries about its date window take three.
YEAR_FROM, YEAR_TO = 1900, 2200
WINDOW_FROM, WINDOW_TO = 1996, 1999
INGESTED = date(2025, 1, 1)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(mutations(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze(spark, sf_dir), YEAR_FROM, YEAR_TO, INGESTED)


def window_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of a window of three years."""
    return to_silver(bronze(spark, sf_dir), WINDOW_FROM, WINDOW_TO, INGESTED)


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, layer: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer written once per application and folder, and read by all queries after that."""
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    if key not in _STORED:
        _STORED[key] = stage_table(build(), layer)
    return _STORED[key]


def stored_keyed(spark: SparkSession, sf_dir: str, layer: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer of silver rows, written without their content key. The key is a digest of columns that the layer holds, and most of a row's
    bytes: readers that ask for it compute it, the others neither read nor write it."""
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    if key not in _STORED:
        rows = build()
        digested = [_POSTAL if c == "code_postal" and _POSTAL in rows.columns else c for c in DEDUP_KEY]
        keyed = stage_table(rows.drop("id_unique"), layer).withColumn("id_unique", row_key(digested))
        _STORED[key] = keyed.select(*[c for c in rows.columns if c != _POSTAL])
    return _STORED[key]


# The postal code that the content key digests, in layers whose features pad it.
_POSTAL = "_code_postal"


def _with_postal(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_POSTAL, F.col("code_postal"))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written table, for queries that read it more than once."""
    return stored_keyed(spark, sf_dir, "silver", lambda: silver(spark, sf_dir))


def stored_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned price segments as a written table."""
    return stored_keyed(spark, sf_dir, "segments", lambda: clean_segments(stored_silver(spark, sf_dir)))


def second_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows of the middle price segment."""
    return stored_segments(spark, sf_dir).where(F.col("segment") == 2)


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered features of the middle segment with the lot of each row."""
    return stored_keyed(spark, sf_dir, "features", lambda: with_lot(engineered(_with_postal(second_segment(spark, sf_dir)))))


def stored_engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered features of all three segments, with the lot and the fold of each row."""
    return stored_keyed(spark, sf_dir, "engineered", lambda: with_fold(with_lot(engineered_by(_with_postal(stored_segments(spark, sf_dir))))))


def stored_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leak-free ones of :func:`stored_engineered`."""
    return leak_free(stored_engineered(spark, sf_dir))
