"""Cross-entropy difference: how much more a document looks like the target than like the corpus.

Two bigram models over all words, one smoothing and one total (background counts are scaled to the size of
the target) give a loss for every word. The score is the mean of target loss less background loss; lower means more
like the target.

All words and bigrams of all documents are counted, by 64-bit hashes; what is gathered grows with the corpus. Counts
of words, of histories and of n-grams are tables, joined to give the loss difference of each n-gram once; documents send
their distinct n-grams with their numbers and get the differences by a join on a 64-bit hash of the n-gram. Only totals
reach the driver. Differences are whole millionths of a nat, so that sums do not depend on their order.

A word after another is a bigram; a document's first word counts alone. With c(h, w), c(h), u(w) the counts of a
model, N their total and V the number of words,
p(w) = (u(w) + 0.5) / (N + 0.5 (V + 1)) and p(w | h) = (c(h, w) + PRIOR p(w)) / (c(h) + PRIOR).
With ``vocabulary`` only so many most frequent words are told apart: the others are one word, which counts alone
and has no bigram after it.

Defined results: documents without words have score 0; rows equal in id and text are one row of the
result; null ids are documents, never of the target; without a target all scores are 0;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import stage_table

from .ngrams import MICRO, Vocabulary, frequent_words
from .words import NOT_PUNCTUATION, Words, batches

PRIOR = 20.0
BROADCAST_ROWS = 1_000_000
# In place of the word before a word that counts alone, and of all words that are not told apart.
_NONE, _OTHER = np.uint64(0), np.uint64(1)


def _ngrams(column: pa.Array, known: Vocabulary | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, word before and word of each place, and the number of words of each row."""
    words = Words(column, NOT_PUNCTUATION)
    word, sizes = words.hashes, np.diff(words.bounds).astype(np.int64)
    if known is not None:
        word = np.where(known.numbers(word) < 0, _OTHER, word)
    before = np.concatenate([[_NONE], word[:-1]])[: len(word)].astype(np.uint64)
    before[words.bounds[:-1][sizes > 0]] = _NONE
    if known is not None:
        before[(before == _OTHER) | (word == _OTHER)] = _NONE
    return np.repeat(np.arange(len(sizes)), sizes), before, word, sizes


def _tally(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different combination of keys, and the combination's number for every place."""
    order = np.lexsort(keys)
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return order[fresh], number


def _counted(docs: DataFrame, vocabulary: list[int] | None) -> DataFrame:
    """The stored table (before, word, target, n) of all n-grams of the documents (t, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(stream):
        known = None if shared.value is None else Vocabulary(shared.value)
        for batch in batches(stream):
            row_of, before, word, _ = _ngrams(batch.column(1), known)
            at, number = _tally(before, word)
            n = np.bincount(number, minlength=len(at)).astype(np.int64)
            target = np.bincount(number, np.asarray(batch.column(0))[row_of], minlength=len(at)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(before[at].view(np.int64)), pa.array(word[at].view(np.int64)), pa.array(target), pa.array(n)],
                names=["before", "word", "target", "n"],
            )

    rows = docs.select("t", "text").mapInArrow(run, "before long, word long, target long, n long")
    return stage_table(rows.groupBy("before", "word").agg(F.sum("target").alias("target"), F.sum("n").alias("n")), "counts")


def _differences(counts: DataFrame) -> DataFrame:
    """The stored table (key, difference): target loss less background loss of each n-gram."""
    single = stage_table(counts.groupBy("word").agg(F.sum("target").alias("u_target"), F.sum("n").alias("u_n")), "words")
    sums = single.agg(
        F.sum("u_target").alias("target"), F.sum("u_n").alias("n"), F.count_if(F.col("word") != int(_OTHER)).alias("words")
    ).first()
    target, scale = float(sums["target"] or 0), (sums["target"] or 0) / (sums["n"] or 1)
    pairs = F.col("before") != int(_NONE)
    history = counts.filter(pairs).groupBy(F.col("before").alias("history"))
    history = stage_table(history.agg(F.sum("target").alias("h_target"), F.sum("n").alias("h_n")), "histories")
    joined = counts.join(single, "word").join(history, counts["before"] == F.col("history"), "left")

    def loss(u: str, c: str, h: str, by: float) -> Column:
        p = (F.col(u) * by + 0.5) / (target + 0.5 * (sums["words"] + 1))
        return -F.log(F.when(pairs, (F.col(c) * by + PRIOR * p) / (F.col(h) * by + PRIOR)).otherwise(p))

    difference = loss("u_target", "target", "h_target", 1.0) - loss("u_n", "n", "h_n", scale)
    difference = F.rint(MICRO * difference).cast("long").alias("difference")
    return stage_table(joined.select(F.xxhash64("before", "word").alias("key"), difference), "differences")


def _asked(docs: DataFrame, vocabulary: list[int] | None) -> DataFrame:
    """(id, h, key, times, n): the distinct n-grams of each document, and a row with its number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([docs.schema["id"], docs.schema["h"], *[T.StructField(c, T.LongType()) for c in ("before", "word", "times", "n")]])

    def run(stream):
        known = None if shared.value is None else Vocabulary(shared.value)
        for batch in batches(stream):
            row_of, before, word, sizes = _ngrams(batch.column(2), known)
            at, number = _tally(word, before, row_of)
            rows = np.concatenate([np.arange(len(sizes)), row_of[at]])
            # The row of a document adds no difference, whatever the n-gram it meets; its hash spreads these rows.
            whole = lambda own, of: pa.array(np.concatenate([own, of]))
            n = pa.array(np.concatenate([sizes, np.zeros(len(at), np.int64)]), mask=np.arange(len(rows)) >= len(sizes))
            spread = np.asarray(batch.column(1).fill_null(0), dtype=np.int64)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), batch.column(1).take(take), whole(spread, before[at].view(np.int64)),
                whole(spread, word[at].view(np.int64)),
                whole(np.zeros(len(sizes), np.int64), np.bincount(number, minlength=len(at)).astype(np.int64)), n,
            ], names=["id", "h", "before", "word", "times", "n"])

    return docs.select("id", "h", "text").mapInArrow(run, schema).select("id", "h", F.xxhash64("before", "word").alias("key"), "times", "n")


def score_documents(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int | None = None,
) -> DataFrame:
    """``id_col, text_hash, n_words, score`` (millionths of a nat per word) of every document; ``target`` holds the target's ids."""
    docs = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"), F.col(text_col).cast("string").alias("text")
    )
    words = None if vocabulary is None else frequent_words(docs, vocabulary, NOT_PUNCTUATION, fold=True)
    chosen = stage_table(target.select(F.col(id_col).alias("target_id")).filter("target_id IS NOT NULL").distinct(), "target")
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    marked = docs.join(chosen, docs["id"] == F.col("target_id"), "left")
    table = _differences(_counted(marked.select(F.col("target_id").isNotNull().cast("long").alias("t"), "text"), words))
    rows = _asked(docs, words).join(table, "key", "left")
    sums = rows.groupBy("id", "h").agg(
        F.sum("n").alias("n"), F.count("n").alias("copies"), F.sum(F.col("times") * F.coalesce("difference", F.lit(0))).alias("total")
    )
    return sums.select(
        F.col("id").alias(id_col), F.col("h").alias("text_hash"), (F.col("n") / F.col("copies")).cast("long").alias("n_words"),
        F.when(F.col("n") > 0, F.round(F.col("total") / F.col("n"))).otherwise(F.lit(0)).cast("long").alias("score"),
    )
