"""Shared vocabularies and bigram counts for language models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelion.session import stage_table

from .words import Words, batches

MICRO = 1_000_000


def micro(values: np.ndarray) -> np.ndarray:
    """Whole millionths, so that sums do not depend on their order."""
    return np.rint(np.asarray(values) * MICRO).astype(np.int64)


class Vocabulary:
    """Numbers of the known words, by hash."""

    def __init__(self, hashes: Sequence[int] | np.ndarray):
        known = np.array(hashes, np.int64).view(np.uint64)
        self.order = np.argsort(known)
        self.sorted = known[self.order]
        self.size = len(hashes)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it is not known."""
        if not self.size or not len(hashes):
            return np.full(len(hashes), -1, np.int64)
        place = np.minimum(np.searchsorted(self.sorted, hashes), self.size - 1)
        return np.where(self.sorted[place] == hashes, self.order[place], -1)


def _repeated(docs: DataFrame, is_word: np.ndarray, fold: bool) -> DataFrame:
    """(word, n) of the words of ``docs.text`` that occur twice or more, by hash."""

    def run(stream):
        for batch in batches(stream):
            found, counts = np.unique(Words(batch.column(0), is_word, fold).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter("n > 1")


def repeated_words(docs: DataFrame, is_word: np.ndarray, fold: bool) -> np.ndarray:
    """Sorted hashes of all words of ``docs.text`` that occur twice or more."""
    return np.sort(np.asarray(_repeated(docs, is_word, fold).select("word").toArrow()["word"], dtype=np.int64))


def frequent_words(docs: DataFrame, size: int, is_word: np.ndarray, fold: bool, by: str | None = None) -> list[int]:
    """Hashes of the ``size`` most frequent words of ``docs.text`` that occur twice or more, counted over all documents.
    With ``by``, the groups of this column take turns, each with its most frequent words."""
    if by is not None:
        return _frequent_in_turn(docs, size, is_word, fold, by)

    counts = stage_table(_repeated(docs, is_word, fold), "words")
    # Eight steps per power of two: the step that holds the last word wanted keeps all rarer words out of the sort.
    step = F.floor(F.log2("n") * 8).cast("int")
    wanted, least = size, 0
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        wanted, least = wanted - row["words"], row["step"]
        if wanted <= 0:
            break
    top = counts.filter(step >= least).orderBy(F.desc("n"), "word").limit(size)
    return [row["word"] for row in top.collect()]


def _frequent_in_turn(docs: DataFrame, size: int, is_word: np.ndarray, fold: bool, by: str) -> list[int]:
    def run(stream):
        for batch in batches(stream):
            kinds = batch.column(1).dictionary_encode()
            words = Words(batch.column(0), is_word, fold)
            of = np.repeat(np.asarray(kinds.indices.fill_null(-1), dtype=np.int64), np.diff(words.bounds))
            for kind in np.unique(of).tolist():
                found, counts = np.unique(words.hashes[of == kind], return_counts=True)
                name = kinds.dictionary[kind].as_py() if kind >= 0 else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), kinds.dictionary.type), pa.array(found.view(np.int64)), pa.array(counts)],
                    names=["of", "word", "n"],
                )

    rows = docs.select("text", F.col(by).cast("string").alias("of")).mapInArrow(run, "of string, word long, n long")
    counts = stage_table(rows.groupBy("of", "word").agg(F.sum("n").alias("n")).filter("n > 1"), "words")
    turn = F.row_number().over(Window.partitionBy("of").orderBy(F.desc("n"), "word"))
    turns = counts.withColumn("turn", turn).filter(F.col("turn") <= size)
    first = turns.groupBy("word").agg(F.min("turn").alias("turn"), F.sum("n").alias("n"))
    return [row["word"] for row in first.orderBy("turn", F.desc("n"), "word").limit(size).collect()]


def tallied(row_of: np.ndarray, keys: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """Per row, its distinct keys and how often each occurs."""
    order = np.lexsort((keys, row_of))
    row_of, keys = row_of[order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], (row_of[1:] != row_of[:-1]) | (keys[1:] != keys[:-1])])[: len(keys)])
    offsets = np.searchsorted(row_of[first], np.arange(rows + 1)).astype(np.int32)
    lists = lambda values: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    return lists(keys[first].astype(np.int64)), lists(np.diff(np.append(first, len(keys))).astype(np.int32))


def bigram_keys(numbers: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its row, the number of the word before it in the row (-1: unknown or none), whether both
    are known, and the key of the two."""
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    before = np.concatenate([[-1], numbers[:-1]])[: len(numbers)]
    before[bounds[:-1][bounds[:-1] < len(numbers)]] = -1
    both = (before >= 0) & (numbers >= 0)
    return row_of, before, both, before * size + numbers
