"""Spelling variants by a trie-node pair dictionary.

Words are inserted in a trie from their beginning and in another one from their end, and the nodes of both are numbered. Sorted words
number a trie without building it: a word adds the nodes below what it shares with the word before it, so each task numbers the words of
its range, and only the nodes on the path of a range's first word may have been numbered by an earlier range; those are settled by the
longest common prefix of a range's first word and the last word of the range before it (two words per range go through the driver).

A word of n code points enters the dictionary with n pairs (prefix node, suffix node) that skip one code point, and n + 1 pairs that skip none. Equal
pairs mean equal prefixes and suffixes, so two words that share a skipping pair differ by one replaced code point, and a
word that shares a pair that skips none with a skipping pair of another lacks the code point skipped. In a run of equal code points only the
first is skipped for that, so every two neighbours meet at one pair. At a pair meet at most one word per code point of the alphabet and one that
skips none: a group is bounded by the alphabet, and each member gets its number of neighbours there and the best of them.

A word's form is its neighbour of largest count, the smallest in code-point order among equals, if that count is at least twice its own. Roots are
found by following forms, twice as far each round; counts double at each step, so the chain is short.

Defined results: null and empty texts have no words; words of fewer than ``MIN_CHARS`` code points or found fewer than ``MIN_COUNT`` times are no words, also
not as neighbours; repeated rows count each time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import stage_table

MIN_CHARS, MIN_COUNT = 5, 3
LETTERS = r"[A-Za-zÀ-ÿ]+"


def count_words(runs: DataFrame, word: str = "word") -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counts = runs.filter(F.char_length(word) >= MIN_CHARS).groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= MIN_COUNT)


def numbered_trie(words: DataFrame) -> DataFrame:
    """``words`` (word, then other columns) with ``rank`` (place in sorted order) and ``nodes``: the number of the trie node of each prefix, from the
    empty one (0) to the whole word."""
    others, names = words.columns[1:], [*words.columns, "part", "number", "local"]

    def run(stream):
        part, number, last, path, taken = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in stream:
            texts, nodes = batch.column(0).to_pylist(), []
            for text in texts:
                if last is None:
                    # Numbers below 0 stand for the depths on the first word's path.
                    path = list(range(-1, -len(text) - 1, -1))
                else:
                    shared = len(commonprefix((last, text)))
                    path = path[:shared] + list(range(taken + 1, taken + len(text) - shared + 1))
                    taken += len(text) - shared
                last = text
                nodes.append(path)
            size = len(texts)
            if size:
                lengths = np.cumsum([0, *map(len, nodes)])
                flat = np.concatenate([np.array(p, np.int64) for p in nodes])
                yield pa.RecordBatch.from_arrays([
                    *batch.columns, pa.array(np.full(size, part, np.int32)), pa.array(number + np.arange(size, dtype=np.int64)),
                    pa.ListArray.from_arrays(pa.array(lengths.astype(np.int32)), pa.array(flat)),
                ], names=names)
                number += size

    schema = T.StructType([
        *words.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType()),
        T.StructField("local", T.ArrayType(T.LongType())),
    ])
    local = stage_table(words.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(run, schema), "trie")
    place = F.struct("number", "word", "local")
    ends = local.groupBy("part").agg(
        F.min_by("word", "number").alias("first"), F.max(place).alias("last"), F.max(F.array_max("local")).alias("taken")
    ).orderBy("part").collect()
    before, path, rows, words_before, nodes_before = "", [], [], 0, 0
    for row in ends:
        # Nodes of the first word: those of the word before it as far as both agree, and new ones.
        shared, taken = len(commonprefix((before, row["first"]))), max(row["taken"], 0)
        own = path[:shared] + [nodes_before + taken + d for d in range(1, len(row["first"]) - shared + 1)]
        rows.append((row["part"], words_before, nodes_before, own))
        before = row["last"]["word"]
        path = [own[-n - 1] if n < 0 else nodes_before + n for n in row["last"]["local"]]
        words_before += row["last"]["number"] + 1
        nodes_before += taken + len(row["first"]) - shared
    settled = words.sparkSession.createDataFrame(rows, "part int, words_before long, nodes_before long, own array<long>")
    node = lambda n: F.when(n < 0, F.get("own", (-n - 1).cast("int"))).otherwise(F.col("nodes_before") + n)
    return local.join(F.broadcast(settled), "part").select(
        "word", *others, (F.col("words_before") + F.col("number")).alias("rank"),
        F.concat(F.array(F.lit(0).cast("long")), F.transform("local", node)).alias("nodes"),
    )


def pair_dictionary(words: DataFrame) -> DataFrame:
    """(prefix, suffix, rank, n, kind) of ``words`` (rank, n, word, nodes, back: suffix nodes by length): kind 0 skips no code point, 1 the first of equal
    ones, 2 another one."""
    size = F.size("nodes") - 1
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("nodes", i).alias("prefix"), F.get("back", size - 1 - i).alias("suffix"),
        F.when((i > 0) & (F.substring("word", i, F.lit(1)) == F.substring("word", i + 1, F.lit(1))), 2).otherwise(1).alias("kind"),
    ))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("nodes", i).alias("prefix"), F.get("back", size - i).alias("suffix"), F.lit(0).alias("kind"),
    ))
    return words.select("rank", "n", F.explode(F.concat(skipped, whole)).alias("p")).select("p.prefix", "p.suffix", "rank", "n", "p.kind")


def neighbours(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best): the number of near words and the best of them as (n, -rank), of words that have any."""
    member = F.struct("n", (-F.col("rank")).alias("order"), "kind")
    groups = pairs.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("members")).filter(F.size("members") > 1)
    def near(x, y):
        # The word that skips nothing meets those that skip the first of equal code points; others meet if both skip.
        return (x["order"] != y["order"]) & (((x["kind"] > 0) & (y["kind"] > 0)) | (x["kind"] + y["kind"] == 1))

    met = F.transform("members", lambda x: F.struct(
        (-x["order"]).alias("rank"), F.filter("members", lambda y: near(x, y)).alias("near")
    ))
    met = groups.select(F.explode(met).alias("m")).filter(F.size("m.near") > 0)
    best = F.array_max(F.transform("m.near", lambda y: F.struct(y["n"].alias("n"), y["order"].alias("order"))))
    met = met.select("m.rank", F.size("m.near").cast("long").alias("near"), best.alias("best"))
    return met.groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rank, root) of the words that have a form (rank, form): the last word reached by forms."""
    step = stage_table(forms.select("rank", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("rank").alias("at"), F.col("root").alias("further"))
        joined = step.join(ahead, step["root"] == ahead["at"], "left")
        joined = stage_table(joined.select("rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        step = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return step


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct ``words`` (word, n)."""
    words = stage_table(words.select("word", "n"), "words")
    known = numbered_trie(words)
    backwards = numbered_trie(words.select(F.reverse("word").alias("word"))).select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    known = stage_table(known.join(backwards, "word"), "nodes")
    near = neighbours(pair_dictionary(known))
    takes = F.col("best.n") >= 2 * F.col("n")
    told = stage_table(known.select("rank", "word", "n").join(near, "rank", "left").select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, -F.col("best.order")).alias("form"), F.when(takes, F.col("best.n")).alias("form_n"),
    ), "told")
    last = roots(told.filter("form IS NOT NULL").select("rank", "form"))
    names = told.select(F.col("rank").alias("of"), F.col("word").alias("name"))
    found = told.filter("form IS NOT NULL").join(last, "rank")
    found = found.join(names.withColumnsRenamed({"of": "form", "name": "form_word"}), "form").join(names.withColumnsRenamed({"of": "root", "name": "root_word"}), "root")
    found = found.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    alone = told.filter("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return found.unionByName(alone)
