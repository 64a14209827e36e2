"""Exact top-k search by inner product over a vector-approximation file.

Vectors are scaled to whole numbers, floor(1024 x). Every component is approximated by the one-byte
number of a cell whose bounds follow from the number alone: exact near zero, four cells per power of two
beyond, and open cells from 15 * 2**29 on, which leave a bound infinite on one side. The file (ids, cells, exact vectors) is
written once.

Queries go in blocks of bounded size. The first scan of a block reads cells only; it bounds each score from both
sides, and the k-th best lower bound over all vectors becomes the query's threshold. The second scan
visits the vectors whose upper bound reaches the threshold, best bound first, reads them exactly, and
stops when the k-th score is above every bound left. Tasks return at most k rows per query. The results of a block
are written before the next block starts, and its broadcasts are freed.

Defined results: vectors that are null, hold a null or non-finite component, or one that times 1024 is beyond a
double, and rows without an id, take no part; a score beyond a 64-bit number is that number's limit; a query meets vectors of its own length only, and not
rows of its own id; of repeated rows of a query id the smallest vector asks, and repeated candidates
each count; ties go to the smaller id; fewer than k candidates give fewer rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelion.session import fresh_path, stage_table

SCALE = 1024
BLOCK_QUERIES = 1024
_ROWS = 1024
_SMALL = 1 << 31
_SCORE_MIN, _SCORE_MAX = -(1 << 63), (1 << 63) - 1
_TOP, _BOTTOM = 127, 255


def cells(values: np.ndarray) -> np.ndarray:
    """Cell number of each whole number: 0-127 from zero up, 128-255 below. The last of each side is open."""
    size = np.minimum(np.where(values < 0, -values - 1, values), (1 << 33) - 1).astype(np.int64)
    power = np.frexp(np.maximum(size, 8).astype(np.float64))[1].astype(np.int64) - 1
    number = np.where(size < 8, size, 8 + (power - 3) * 4 + ((size >> np.maximum(power - 2, 0)) & 3))
    return (number + 128 * (values < 0)).astype(np.uint8)


def cell_bounds() -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest whole number of each cell, 0 where there is none."""
    number = np.arange(128)
    power, part = np.maximum((number - 8) // 4 + 3, 3), (number - 8) % 4
    low = np.where(number < 8, number, (4 + part) << (power - 2))
    high = np.where(number < 8, number, ((5 + part) << (power - 2)) - 1)
    lows, highs = np.concatenate([low, -high - 1]).astype(np.float64), np.concatenate([high, -low - 1]).astype(np.float64)
    highs[_TOP] = lows[_BOTTOM] = 0
    return lows, highs


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as 32-bit numbers, or as the doubles they are where one needs more."""
    return values.astype("<i4" if (np.abs(values) < _SMALL).all() else "<f8").tobytes()


def unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if len(data) == 4 * dims else "<f8").astype(np.float64)


def scores(vectors: np.ndarray, asked: np.ndarray) -> list[int]:
    """Exact inner products with ``asked``, within the bounds of a 64-bit number."""
    widest = float(np.abs(vectors).max(initial=0)) * float(np.abs(asked).max(initial=0)) * len(asked)
    if widest < 2**62:
        return (vectors.astype(np.int64) @ asked.astype(np.int64)).tolist()
    numbers = [int(x) for x in asked]
    exact = (sum(int(x) * y for x, y in zip(row, numbers)) for row in vectors)
    return [min(max(score, _SCORE_MIN), _SCORE_MAX) for score in exact]


def approximation_file(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """The stored table (id, dims, cells, vector), the vector in whole numbers."""

    def run(stream):
        for batch in stream:
            ids, dims, codes, exact = [], [], [], []
            column = batch.column(1)
            for row in range(batch.num_rows):
                value = column[row]
                if not value.is_valid or not batch.column(0)[row].is_valid or value.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    values = np.floor(np.asarray(value.values, dtype=np.float64) * scale)
                if not np.isfinite(values).all():
                    continue
                ids.append(row)
                dims.append(len(values))
                codes.append(cells(values).tobytes())
                exact.append(packed(values))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(ids, pa.int64())), pa.array(dims, pa.int32()),
                pa.array(codes, pa.binary()), pa.array(exact, pa.binary()),
            ], names=["id", "dims", "cells", "vector"])

    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = slim.schema["id"].dataType.simpleString()
    return stage_table(slim.mapInArrow(run, f"id {kind}, dims int, cells binary, vector binary"), "cells")


class _Block:
    """Queries of one length, with what both scans need of them."""

    def __init__(self, rows: list[tuple], dims: int):
        self.ids = [row[0] for row in rows]
        self.exact = np.stack([unpacked(row[1], dims) for row in rows])
        self.up, self.down = np.maximum(self.exact, 0), np.minimum(self.exact, 0)
        self.size = np.abs(self.exact).sum(axis=1)
        self.floor = np.array([row[3] for row in rows], np.float64)
        self.row_of = {}
        for row, key in enumerate(self.ids):
            self.row_of[key] = row

    def bounds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of every query's score with every vector."""
        low, high = (bound[codes].T for bound in cell_bounds())
        with np.errstate(over="ignore", invalid="ignore"):
            # Rounding errs in proportion to the sizes of what is added up, not to the sum.
            slack = 1e-9 * np.outer(self.size, np.maximum(np.abs(low), np.abs(high)).max(axis=0, initial=0)) + 1
            lower, upper = self.up @ low + self.down @ high - slack, self.up @ high + self.down @ low + slack
        lower[np.isnan(lower)], upper[np.isnan(upper)] = -np.inf, np.inf
        top, bottom = (codes == _TOP).T, (codes == _BOTTOM).T
        if top.any() or bottom.any():
            positive, negative = (self.exact > 0).astype(np.float64), (self.exact < 0).astype(np.float64)
            upper[positive @ top + negative @ bottom > 0] = np.inf
            lower[negative @ top + positive @ bottom > 0] = -np.inf
        return np.clip(lower, _SCORE_MIN, _SCORE_MAX), np.clip(upper, _SCORE_MIN, _SCORE_MAX)


def _by_length(rows: list[tuple]) -> dict[int, _Block]:
    """Blocks of the rows (id, vector, dims, floor) by length."""
    lengths: dict[int, list[tuple]] = {}
    for row in rows:
        lengths.setdefault(row[2], []).append(row)
    return {dims: _Block(found, dims) for dims, found in lengths.items()}


def _parts(stream, blocks: dict[int, _Block]):
    """Slices of the batches with one vector length each: (block, ids, cells, batch slice)."""
    for batch in stream:
        for dims in pc.unique(batch.column(1)).to_pylist():
            if dims not in blocks:
                continue
            same = batch.filter(pc.equal(batch.column(1), dims))
            for begin in range(0, same.num_rows, _ROWS):
                part = same.slice(begin, _ROWS)
                codes = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, dims)
                yield dims, part, codes


def _thresholds(file: DataFrame, shared, k: int) -> DataFrame:
    """The k-th best lower bound of each query that has k candidates."""

    def run(stream):
        blocks = _by_length(shared.value)
        best = {dims: np.full((len(block.ids), 0), -np.inf) for dims, block in blocks.items()}
        for dims, part, codes in _parts(stream, blocks):
            block = blocks[dims]
            low, _ = block.bounds(codes)
            for column, key in enumerate(part.column(0).to_pylist()):
                if key in block.row_of:
                    low[block.row_of[key], column] = -np.inf
            joined = np.concatenate([best[dims], low], axis=1)
            best[dims] = -np.partition(-joined, k - 1, axis=1)[:, :k] if joined.shape[1] > k else joined
        ids, lows = [], []
        for dims, block in blocks.items():
            for key, row in zip(block.ids, best[dims]):
                found = row[np.isfinite(row)]
                ids += [key] * len(found)
                lows.append(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, _arrow_type(shared.value)), pa.array(np.concatenate(lows) if lows else np.zeros(0))], names=["query", "low"]
        )

    kind = file.schema["id"].dataType.simpleString()
    lows = file.select("id", "dims", "cells").mapInArrow(run, f"query {kind}, low double")
    order = Window.partitionBy("query").orderBy(F.desc("low"))
    return lows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).filter(F.col("rank") == k)


def _arrow_type(rows: list[tuple]) -> pa.DataType:
    return pa.array([row[0] for row in rows]).type


def _exact(file: DataFrame, shared, k: int) -> DataFrame:
    """(query, id, score): in each task, the k best of the vectors that the bounds leave."""

    def run(stream):
        blocks = _by_length(shared.value)
        best = {dims: [[] for _ in block.ids] for dims, block in blocks.items()}
        for dims, part, codes in _parts(stream, blocks):
            block = blocks[dims]
            _, high = block.bounds(codes)
            keys = part.column(0).to_pylist()
            stored = part.column(3)
            for query in np.flatnonzero((high >= block.floor[:, None]).any(axis=1)):
                bound = high[query]
                order = np.flatnonzero(bound >= block.floor[query])
                order = order[np.argsort(-bound[order], kind="stable")]
                found = best[dims][query]
                for begin in range(0, len(order), 64):
                    some = order[begin : begin + 64]
                    if len(found) == k and -found[-1][0] > bound[some[0]]:
                        break
                    exact = np.stack([unpacked(stored[i].as_py(), dims) for i in some.tolist()])
                    found_scores = scores(exact, block.exact[query])
                    fresh = [(-s, keys[i]) for s, i in zip(found_scores, some.tolist()) if keys[i] != block.ids[query]]
                    found = sorted(found + fresh)[:k]
                best[dims][query] = found
        queries, ids, points = [], [], []
        for dims, block in blocks.items():
            for key, found in zip(block.ids, best[dims]):
                queries += [key] * len(found)
                ids += [x[1] for x in found]
                points += [-x[0] for x in found]
        kind = _arrow_type(shared.value)
        yield pa.RecordBatch.from_arrays([pa.array(queries, kind), pa.array(ids, kind), pa.array(points, pa.int64())], names=["query", "id", "score"])

    kind = file.schema["id"].dataType.simpleString()
    return file.mapInArrow(run, f"query {kind}, id {kind}, score long")


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, <id_col>, score`` for every row of ``vectors`` chosen by the condition ``queries`` on its id."""
    spark = vectors.sparkSession
    file = approximation_file(vectors, id_col, vector_col)
    asked = file.withColumnRenamed("id", id_col).filter(queries).groupBy(F.col(id_col).alias("id"))
    asked = stage_table(asked.agg(F.min(F.struct("vector", "dims")).alias("least")).select("id", "least.*"), "asked")
    blocks = max(1, -(-asked.count() // block_queries))
    kind = file.schema["id"].dataType.simpleString()
    schema, place = f"query {kind}, id {kind}, score long", fresh_path(spark, "found")
    _exact(file.limit(0), spark.sparkContext.broadcast([]), k).write.parquet(place)
    for number in range(blocks):
        chosen = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).select("id", "vector", "dims")
        rows = [(r["id"], bytes(r["vector"]), r["dims"]) for r in chosen.collect()]
        if not rows:
            continue
        first = spark.sparkContext.broadcast([(*row, -np.inf) for row in rows])
        floors = {r["query"]: r["low"] for r in _thresholds(file, first, k).collect()}
        first.unpersist()
        second = spark.sparkContext.broadcast([(*row, floors.get(row[0], -np.inf)) for row in rows])
        _exact(file, second, k).write.mode("append").parquet(place)
        second.unpersist()
    results = spark.read.schema(schema).parquet(place)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )
