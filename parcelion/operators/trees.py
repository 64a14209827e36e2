"""Forests and boosted trees of tables that fit a task, grown there; larger tables go to Spark's learners.

Spark's learners count cells for every node of a level, shuffle them and choose on the driver. A hundred trees of depth 15 have millions of nodes of a few
rows, and their cells are what time and shuffle go into. Here rows become one byte per feature. Up to ``LOCAL_ROWS`` of them are sent to all tasks,
and a task grows a whole tree of a forest, or a whole run of boosting, from all rows. The settings are those of Spark's learners and mean the same:
bagging by Poisson weights, the largest decrease of variance at cuts between ``maxBins`` bins, every feature tried at every node; boosting
learns twice the residual after a first tree of full weight.

A row's bagging weights come from a digest of its bytes and its number among equal rows, so they do not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.operators.boosting import TIE, coded
from parcelion.session import stage_table

# Rows that are sent to all tasks, a byte per feature each.
LOCAL_ROWS = 1 << 19
# Cells and row bytes that are counted at once.
CELLS, HELD = 1 << 21, 1 << 22


@dataclass(frozen=True)
class Grown:
    """A tree by node, the root first: a leaf has feature -1; the children of a node are ``left`` and ``left`` + 1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def predict(self, codes: np.ndarray) -> np.ndarray:
        """Bins up to a node's cut go left."""
        at, moving = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(moving := moving[self.feature[at[moving]] >= 0]):
            node = at[moving]
            at[moving] = self.left[node] + (codes[moving, self.feature[node]] > self.cut[node])
        return self.value[at]


def _tables(codes: np.ndarray, weight: np.ndarray, target: np.ndarray, node: np.ndarray, nodes: int, first: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weighted target and of weights by (node, cell)."""
    sums, rows = np.zeros(nodes * cells), np.zeros(nodes * cells)
    step = max(HELD // codes.shape[1], 1)
    for begin in range(0, len(codes), step):
        own = slice(begin, begin + step)
        cell = (codes[own] + (first + node[own, None] * cells)).ravel()
        sums += np.bincount(cell, np.repeat(target[own], codes.shape[1]), nodes * cells)
        rows += np.bincount(cell, np.repeat(weight[own], codes.shape[1]), nodes * cells)
    return sums.reshape(nodes, cells), rows.reshape(nodes, cells)


def _best(sums: np.ndarray, rows: np.ndarray, first: np.ndarray, feature_of: np.ndarray, least: float, smallest: float) -> tuple[np.ndarray, ...]:
    """(feature, bin, gain) of each node, -1 where no cut gains; of equal gains the first. With them the node's own sums."""

    def below(table: np.ndarray) -> np.ndarray:
        run = np.cumsum(table, axis=1)
        start = np.concatenate([np.zeros((len(run), 1)), run[:, first[1:] - 1]], axis=1)
        return run - start[:, feature_of]

    end = first[1] if len(first) > 1 else sums.shape[1]
    whole, size = sums[:, :end].sum(axis=1, keepdims=True), rows[:, :end].sum(axis=1, keepdims=True)
    left, n = below(sums), below(rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = left * left / n + (whole - left) ** 2 / (size - n) - whole * whole / size
    gains[(n < least) | (size - n < least)] = -np.inf
    top = gains.max(axis=1)
    at = (gains >= (top - TIE * np.abs(top))[:, None]).argmax(axis=1)
    feature = np.where(top > smallest, feature_of[at], -1)
    return feature, at - first[feature_of[at]], top, whole[:, 0], size[:, 0]


def grow(codes: np.ndarray, y: np.ndarray, weight: np.ndarray, bins: Sequence[int], depth: int, least: float) -> Grown:
    """One tree of all rows of a weight, level by level. ``bins`` is the number of bins by feature."""
    first = np.concatenate([[0], np.cumsum(bins)[:-1]]).astype(np.int64)
    cells, feature_of = int(sum(bins)), np.repeat(np.arange(len(bins)), bins)
    own = np.flatnonzero(weight > 0)
    codes, weight = codes[own], weight[own].astype(float)
    mean = np.average(y[own], weights=weight)
    target = weight * (y[own] - mean)
    smallest = 1e-12 * float((target * target / weight).sum()) + 1e-300
    node, count, done = np.zeros(len(own), np.int64), 1, 0
    parts = {name: [] for name in ("feature", "cut", "left", "value", "gain")}
    for level in range(depth + 1):
        found = []
        begins = np.searchsorted(node, np.arange(count + 1))
        step = max(CELLS // cells, 1)
        for low in range(0, count, step):
            high = min(low + step, count)
            rows = slice(begins[low], begins[high])
            if level == depth:
                sums, sizes = (np.bincount(node[rows] - low, t[rows], high - low) for t in (target, weight))
                found.append((np.full(high - low, -1), np.zeros(high - low, np.int64), np.zeros(high - low), sums, sizes))
            else:
                tables = _tables(codes[rows], weight[rows], target[rows], node[rows] - low, high - low, first, cells)
                found.append(_best(*tables, first, feature_of, least, smallest))
        feature, cut, gain, sums, sizes = (np.concatenate(x) for x in zip(*found))
        splits = feature >= 0
        child = 2 * (np.cumsum(splits) - 1)
        done += count
        for name, values in zip(parts, (feature, np.where(splits, cut, 0), np.where(splits, done + child, 0), mean + sums / sizes, np.where(splits, gain, 0.0))):
            parts[name].append(values)
        if not splits.any():
            break
        kept = np.flatnonzero(splits[node])
        at = node[kept]
        node = child[at] + (codes[kept, feature[at]] > cut[at])
        order = np.argsort(node, kind="stable")
        kept, node, count = kept[order], node[order], 2 * int(splits.sum())
        codes, weight, target = codes[kept], weight[kept], target[kept]
    kinds = (np.int16, np.uint8, np.int32, float, float)
    return Grown(*(np.concatenate(x).astype(kind) for x, kind in zip(parts.values(), kinds)))


# Chances of a row to come up so often or less in a bag.
_POISSON = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 16)]))


def bag(digest: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row comes up in a tree's bag."""
    mixed = digest.view(np.uint64) + np.uint64((tree + 1 + seed * 1_000_003) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    chance = ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_POISSON, chance, "right").astype(float)


def numbered(digest: np.ndarray) -> np.ndarray:
    """Digests of sorted rows, told apart by each row's number among equal ones."""
    starts = np.flatnonzero(np.concatenate([[True], digest[1:] != digest[:-1]]))
    number = np.arange(len(digest)) - np.repeat(starts, np.diff([*starts, len(digest)]))
    return (digest.view(np.uint64) + number.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)).view(np.int64)


def boosted(codes: np.ndarray, y: np.ndarray, bins: Sequence[int], rounds: int, rate: float, depth: int, least: float) -> list[Grown]:
    """Trees of boosted squared error: the first learns the target, the others twice what is left of it."""
    trees, told, ones = [], np.zeros(len(y)), np.ones(len(y))
    for number in range(rounds):
        trees.append(grow(codes, 2 * (y - told) if number else y, ones, bins, depth, least))
        told += (rate if number else 1.0) * trees[-1].predict(codes)
    return trees


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts that part the values in at most ``bins`` bins: between all of few values, at quantiles of many."""
    kinds = np.unique(values)
    return (kinds[1:] + kinds[:-1]) / 2 if len(kinds) <= bins else np.unique(np.quantile(values, np.arange(1, bins) / bins))


@dataclass(frozen=True)
class Ensemble:
    """A fitted model with the calls of Spark's."""

    edges: list[np.ndarray]
    trees: list[Grown]
    weights: list[float]
    per_tree: bool

    def predict(self, values: np.ndarray) -> np.ndarray:
        codes = coded(list(values.T), self.edges)
        return sum((w * tree.predict(codes) for w, tree in zip(self.weights, self.trees)), np.zeros(len(codes)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction`` of the vectors in ``_features``."""
        shared, width = df.sparkSession.sparkContext.broadcast(self), len(self.edges)

        def run(vectors: pa.Array) -> pa.Array:
            return pa.array(shared.value.predict(np.asarray(vectors.flatten(), dtype=float).reshape(-1, width)))

        return df.withColumn("prediction", F.arrow_udf(run, "double")(vector_to_array("_features")))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802, the name of Spark's models
        """Share of the gain by feature: of each tree's in a forest, of the whole when boosted."""
        whole = np.zeros(len(self.edges))
        for tree in self.trees:
            splits = tree.feature >= 0
            own = np.bincount(tree.feature[splits], tree.gain[splits], len(whole))
            whole += own / (own.sum() or 1.0) if self.per_tree else own
        return DenseVector(whole / (whole.sum() or 1.0))


class Learner:
    """A forest, or boosted trees, by the settings of Spark's learner."""

    spark_learner = RandomForestRegressor

    def __init__(self, **settings):
        self.settings = settings

    def fit(self, rows: DataFrame):
        """``rows`` have a vector ``_features`` and a number ``_label``."""
        n = rows.count()
        if not 0 < n <= LOCAL_ROWS:
            return self.spark_learner(featuresCol="_features", labelCol="_label", **self.settings).fit(rows)
        given = stage_table(rows.select(vector_to_array("_features").alias("x"), F.col("_label").alias("y")), "learnt")
        edges = self._edges(given)

        def run(stream):
            for batch in stream:
                if batch.num_rows:
                    values = np.asarray(batch.column(0).flatten(), dtype=float).reshape(batch.num_rows, -1)
                    codes = coded(list(values.T), edges)
                    yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in codes], pa.binary()), batch.column(1)], names=["codes", "y"])

        table = given.mapInArrow(run, "codes binary, y double").withColumn("digest", F.xxhash64("codes", "y")).toArrow()
        digest, y = (np.asarray(table[c], dtype=kind) for c, kind in (("digest", np.int64), ("y", float)))
        codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.uint8).reshape(n, -1)
        order = np.lexsort((y, digest))
        return self._learnt(rows, edges, (codes[order], y[order], numbered(digest[order])))

    def _edges(self, given: DataFrame) -> list[np.ndarray]:
        """Cuts of every feature. A task holds the values of one."""
        bins = self.settings["maxBins"]

        def run(frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"pos": [int(frame.pos.iat[0])], "edges": [edges_of(frame.col.to_numpy(float), bins).tolist()]})

        found = given.select(F.posexplode("x")).groupBy("pos").applyInPandas(run, "pos int, edges array<double>").collect()
        return [np.array(r.edges, float) for r in sorted(found, key=lambda r: r.pos)]

    def _grown(self, spark, tables: tuple, tasks: int, build) -> list[Grown]:
        """Trees of ``tasks`` tasks, in order. ``build`` gives a task's trees from the rows."""
        shared = spark.sparkContext.broadcast(tables)

        def run(stream):
            for batch in stream:
                for number in batch.column(0).to_pylist():
                    for place, tree in enumerate(build(shared.value, number)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([number]), pa.array([place]), *(pa.array([part.tobytes()], pa.binary()) for part in vars(tree).values())], names=names
                        )

        names = ["number", "place", *Grown.__dataclass_fields__]
        schema = "number long, place long, " + ", ".join(f"{c} binary" for c in Grown.__dataclass_fields__)
        found = spark.range(0, tasks, 1, tasks).mapInArrow(run, schema).collect()
        shared.unpersist()
        kinds = (np.int16, np.uint8, np.int32, float, float)
        return [Grown(*(np.frombuffer(r[i + 2], kind) for i, kind in enumerate(kinds))) for r in sorted(found, key=lambda r: r[:2])]

    def _learnt(self, rows: DataFrame, edges: list[np.ndarray], tables: tuple) -> Ensemble:
        s, bins = self.settings, [len(e) + 1 for e in edges]

        def build(tables, number):
            codes, y, digest = tables
            return [grow(codes, y, bag(digest, number, s["seed"]), bins, s["maxDepth"], s["minInstancesPerNode"])]

        trees = self._grown(rows.sparkSession, tables, s["numTrees"], build)
        return Ensemble(edges, trees, [1 / len(trees)] * len(trees), True)


class BoostedLearner(Learner):
    spark_learner = GBTRegressor

    def _learnt(self, rows: DataFrame, edges: list[np.ndarray], tables: tuple) -> Ensemble:
        s, bins = self.settings, [len(e) + 1 for e in edges]

        def build(tables, number):
            codes, y, _ = tables
            return boosted(codes, y, bins, s["maxIter"], s["stepSize"], s["maxDepth"], s["minInstancesPerNode"])

        trees = self._grown(rows.sparkSession, tables, 1, build)
        return Ensemble(edges, trees, [1.0] + [s["stepSize"]] * (len(trees) - 1), False)
