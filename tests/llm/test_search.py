import numpy as np
from pyspark.sql import functions as F

from parcelion.llm import search as S


def test_cells_hold_their_numbers():
    values = np.array([*range(-300, 300), 1023, -1024, 2**32, -(2**32), 12345678], np.float64)
    low, high = S.cell_bounds()
    codes = S.cells(values)
    assert ((low[codes] <= values) & (values <= high[codes])).all()
    assert (low[1:128] > high[:127]).all() and (high[129:255] < low[128:254]).all()
    assert S.cells(np.array([15 * 2.0**29, 1e300, -15 * 2.0**29 - 1, -1e300])).tolist() == [127, 127, 255, 255]


def test_bounds_hold_the_score():
    rng = np.random.default_rng(4)
    for size in (900, 10**6, 10**12, 10**30):
        scale = np.where(rng.random((200, 16)) < 0.2, size, 50.0)
        vectors, asked = np.floor(rng.normal(size=(200, 16)) * scale), np.floor(rng.normal(size=(5, 16)) * 900)
        block = S._Block([(i, S.packed(row), 16, 0.0) for i, row in enumerate(asked)], 16)
        low, high = block.bounds(S.cells(vectors))
        for query, row in enumerate(asked):
            exact = [sum(int(x) * int(y) for x, y in zip(row, other)) for other in vectors]
            exact = [min(max(score, -(2**63)), 2**63 - 1) for score in exact]
            assert S.scores(vectors, row) == exact
            assert all(a <= score <= b for a, score, b in zip(low[query].tolist(), exact, high[query].tolist()))


def test_large_components_rank(spark):
    rows = [(0, [1.0, 1.0]), (1, [70000.0, 0.0]), (2, [1.0, 0.0]), (3, [1e30, 0.0]), (4, [2e30, 1.0]), (5, [-1e300, 0.0]),
            (6, [float("inf"), 0.0]), (7, [1e308, 0.0]), (100, [0.0, 2.0**40])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in S.top_k(df, F.col("vec_id") % 100 == 0, k=4, block_queries=1).collect()}
    top, unit = 2**63 - 1, 1024 * 1024
    assert [found[0, i] for i in range(1, 5)] == [(3, top), (4, top), (100, 2**40 * unit), (1, 70000 * unit)]
    assert [found[100, i] for i in range(1, 5)] == [(0, 2**40 * unit), (4, 2**40 * unit), (1, 0), (2, 0)]


def test_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert S.top_k(df, F.col("vec_id") % 100 == 0).count() == 0


def test_blocks_and_ties_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    table = rng.normal(size=(400, 6)).round(1)
    table[50:80] = table[0]
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(table)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    whole = np.floor(table.astype(np.float32).astype(np.float64) * 1024).astype(int)
    expected = set()
    for q in range(0, 400, 10):
        scores = whole @ whole[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:7]
        expected |= {(q, rank + 1, i, int(scores[i])) for rank, i in enumerate(order)}
    for size in (1024, 9):
        found = S.top_k(df, F.col("vec_id") % 10 == 0, k=7, block_queries=size).collect()
        assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == expected and len(found) == len(expected)
