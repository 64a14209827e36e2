"""Shingle sets of texts, and the exact keys of sets that are alike."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelion.session import stage_table

from .words import NOT_SPACE, Words, batches, mix, ngram_hashes

_U = np.uint64
# Up to here the pairs of nodes and pivots go to the texts, and not the texts through a shuffle to the pairs.
BROADCAST_PAIRS = 250_000
# Members of a key that are compared with each other, for want of a pivot.
FEW = 16


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    grams = ngram_hashes(words.hashes, size)
    sets = []
    for begin, end in zip(words.bounds[:-1], words.bounds[1:]):
        if end - begin >= size:
            sets.append(np.unique(grams[begin : end - size + 1]))
        elif end > begin:
            sets.append(ngram_hashes(words.hashes[begin:end], int(end - begin)))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def node_of(shingles: np.ndarray) -> int:
    """One number for a whole set."""
    return int(mix(np.array([mix(shingles).sum(dtype=_U) + _U(len(shingles))], _U)).view(np.int64)[0])


def one_per_node(rows: DataFrame) -> DataFrame:
    """The stored table (node, text) with one row for each node of ``rows``. Texts are shuffled only if a node comes twice."""
    found = stage_table(rows, "texts")
    if found.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty():
        return found
    return stage_table(found.dropDuplicates(["node"]), "texts")


def rare_keys(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, node, n, label, short): of each node (node, label, n) the shingles that it cannot all lack in common with a partner, rarest first, as far
    as they occur under several labels. Two sets that are alike share one of the rarest ``n - least common + 1`` shingles of the
    larger and of the rarest ones of the smaller, marked short, where the least common number is higher."""

    def run(stream):
        for batch in batches(stream):
            sets = shingle_sets(Words(batch.column(3), NOT_SPACE), size)
            counts = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(sets).view(np.int64)), *(pa.array(np.repeat(np.asarray(batch.column(i)), counts)) for i in range(3)),
            ], names=["key", "node", "n", "label"])

    rows = members.join(texts, "node").select("node", "n", "label", "text").mapInArrow(run, "key long, node long, n long, label long")
    found = rows.groupBy("key").agg(F.count(F.lit(1)).alias("often"), F.min("label").alias("low"), F.max("label").alias("high"))
    rows = rows.join(found.filter("low < high").select("key", "often"), "key")
    # Shingles of one label only come first in the order of rarity, and meet nobody.
    own = Window.partitionBy("node")
    place = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("often", "key"))
    n = F.col("n")
    most, least = n - F.ceil(n * percent / 100) + 1, n - F.ceil(2 * n * percent / (100 + percent)) + 1
    rows = rows.withColumn("place", place).filter(F.col("place") <= most)
    return rows.select("key", "node", "n", "label", (F.col("place") <= least).alias("short"))


def counted_keys(texts: DataFrame, size: int, percent: int, cells: int = 1 << 20) -> DataFrame:
    """(key, node, short): as :func:`rare_keys`, with rarity told by a table of ``cells`` counters instead of a count per shingle, so that only the keys
    are shuffled and not all shingles. Any order that all sets share is right; a shingle that is found much oftener than the others
    in its counter comes late in this one. Keys that one node alone has are left out."""

    def count(stream):
        counters = np.zeros(cells, np.int64)
        for batch in batches(stream, 2 << 20):
            found = shingle_sets(Words(batch.column(1), NOT_SPACE), size)
            counters += np.bincount((np.concatenate(found) & _U(cells - 1)).astype(np.int64), minlength=cells)
        used = np.flatnonzero(counters)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counters[used])], names=["cell", "n"])

    texts = texts.select("node", "text")
    table = texts.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counters = np.zeros(cells, np.int64)
    counters[table["cell"].to_numpy()] = table["n"].to_numpy()
    middle = np.median(counters)
    spread = max(2 * 1.4826 * np.median(np.abs(counters - middle)), 2.0)
    levels = np.ceil(8 * np.log2(np.maximum((counters - middle) / spread, 1))).astype(np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def keys(stream):
        for batch in batches(stream, 2 << 20):
            found, nodes, short = [], [], []
            for node, shingles in zip(batch.column(0).to_pylist(), shingle_sets(Words(batch.column(1), NOT_SPACE), size)):
                n = len(shingles)
                most, least = n - -(-n * percent // 100) + 1, n - -(-2 * n * percent // (100 + percent)) + 1
                level = shared.value[(shingles & _U(cells - 1)).astype(np.int64)].astype(_U)
                own = shingles[np.argsort((level << _U(56)) | (shingles >> _U(8)), kind="stable")[:most]]
                found.append(own)
                nodes.append(np.full(len(own), node, np.int64))
                short.append(np.arange(len(own)) < least)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(short))], names=["key", "node", "short"]
            )

    rows = stage_table(texts.mapInArrow(keys, "key long, node long, short boolean"), "keys")
    several = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key")
    return rows.join(several, "key", "left_semi")


def by_size(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members whose key has ``FEW`` of them at most, and the others."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    sized = stage_table(members.join(sizes, "key"), "sized")
    return sized.filter(F.col("members") <= FEW).drop("members"), sized.filter(F.col("members") > FEW).drop("members")


def pivot_differences(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(pivot, pivot_label, node, n, label, cost, free, apart): what every member (key, node, n, label, rank) has otherwise than the first member of its key.

    ``apart`` holds the shingles that only one of the two has, missing from the pivot's h shingles (a of them) or extra (e). ``cost`` is 100 a + percent e and
    ``free`` (100 - percent) h: the two are alike where the cost is not above it."""
    first = F.min_by(F.struct("node", "label"), F.struct("rank", "node")).alias("first")
    pivots = members.groupBy("key").agg(first).select("key", F.col("first.node").alias("pivot"), F.col("first.label").alias("pivot_label"))
    pairs = members.join(pivots, "key").filter("node <> pivot").select("pivot", "pivot_label", "node", "n", "label").distinct()
    pairs = stage_table(pairs, "pivots")
    pivots = pairs.select("pivot").distinct()
    if pairs.count() <= BROADCAST_PAIRS:
        pairs, pivots = F.broadcast(pairs), F.broadcast(pivots)
    wholes = texts.select(F.col("node").alias("pivot"), F.col("text").alias("whole")).join(pivots, "pivot", "left_semi")
    rows = texts.join(pairs, "node").join(wholes, "pivot")

    def run(stream):
        for batch in batches(stream, 2 << 20):
            wholes, sets = (shingle_sets(Words(batch.column(i), NOT_SPACE), size) for i in (5, 6))
            apart = [np.setxor1d(w, s, assume_unique=True) for w, s in zip(wholes, sets)]
            common = [(len(w) + len(s) - len(d)) // 2 for w, s, d in zip(wholes, sets, apart)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:5],
                pa.array([100 * (len(w) - c) + percent * (len(s) - c) for w, s, c in zip(wholes, sets, common)], pa.int64()),
                pa.array([(100 - percent) * len(w) for w in wholes], pa.int64()), pa.array([d.view(np.int64) for d in apart], pa.list_(pa.int64())),
            ], names=["pivot", "pivot_label", "node", "n", "label", "cost", "free", "apart"])

    rows = rows.select("pivot", "pivot_label", "node", F.col("n").cast("long").alias("n"), "label", "whole", "text")
    return rows.mapInArrow(run, "pivot long, pivot_label long, node long, n long, label long, cost long, free long, apart array<long>")


def pivot_keys(differences: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, label, cost, side, need, rest): keys at which all alike nodes meet that have a pivot in common and not both its label.

    Two sets have h - a - a' + s shingles in common, s being those that both miss or both have extra. They are alike where (100 + percent) s is not below
    cost + cost' - free. Nodes that are alike with the pivot are in its component, so one of the two at least is not, and s is above 0: edits of one
    node alone never make a key. As many of the rarest shingles of ``apart`` as s leaves are keys. Two nodes that both are unlike the pivot meet at keys without side;
    one that is alike (side true) and one that is not meet at others. ``need`` and ``rest`` tell of two rows whether the first key that they share can be this one
    (:func:`reachable`)."""
    alike, each = F.col("cost") <= F.col("free"), 100 + percent
    bounds = differences.groupBy("pivot").agg(F.min(F.when(alike, F.col("cost"))).alias("near"), F.min(F.when(~alike, F.col("cost"))).alias("far"))
    slim = differences.select("pivot", "node", "n", "label", "cost", "free", F.size("apart").alias("total"), F.explode("apart").alias("shingle"))
    found = slim.groupBy("pivot", "shingle").agg(F.count(F.lit(1)).alias("often"), F.min("label").alias("low"), F.max("label").alias("high"))
    rows = slim.join(found.filter("low < high").select("pivot", "shingle", "often"), ["pivot", "shingle"])
    # Shingles of one label only come first in the order of rarity, and meet nobody.
    own = Window.partitionBy("pivot", "node")
    rows = rows.withColumn("place", F.col("total") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("often", "shingle"))).join(bounds, "pivot")
    # A partner alike with the pivot has at least percent / 100 of the excess as its cost, or too few shingles apart.
    excess = F.col("cost") - F.col("free")
    with_far = F.col("total") - F.ceil((excess + F.col("far")) / each) + 1
    with_near = F.col("total") - F.greatest(F.ceil((excess + F.col("near")) / each), F.ceil(excess / 100)) + 1
    columns = lambda kind, side: [F.xxhash64("pivot", "shingle", F.lit(kind)).alias("key"), "node", "n", "label", "cost", side.alias("side"), "need", "rest"]
    rows = rows.withColumns({"alike": alike, "with_far": with_far, "with_near": with_near, "need": excess + F.col("cost"), "rest": F.col("total") - F.col("place")})
    rows = stage_table(rows.filter("place <= greatest(with_far, with_near)"), "places")
    both_far = rows.filter("NOT alike AND place <= with_far").select(*columns(0, F.lit(None).cast("boolean")))
    one_far = rows.filter("place <= if(alike, with_far, with_near)").select(*columns(1, F.col("alike")))
    keys = both_far.unionByName(one_far)
    open_keys = keys.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("side").alias("one"), F.max("side").alias("other"))
    open_keys = open_keys.filter("low < high AND (one IS NULL OR one <> other)")
    return keys.join(open_keys.select("key"), "key", "left_semi")


def reachable(percent: int) -> Column:
    """Whether a row and a hub's (hub_*) of one of the :func:`pivot_keys` leave room for the shingles that they must share; rows without side, need and rest always do."""
    sides = F.coalesce(F.col("side") != F.col("hub_side"), F.lit(True))
    room = 2 * (100 + percent) * (1 + F.least("rest", "hub_rest")) >= F.col("need") + F.col("hub_need")
    return sides & F.coalesce(room, F.lit(True))


def without_pivot(rows: DataFrame) -> DataFrame:
    """``rows`` with the columns side, need and rest, all null."""
    return rows.withColumns({"side": F.lit(None).cast("boolean"), "need": F.lit(None).cast("long"), "rest": F.lit(None).cast("long")})
