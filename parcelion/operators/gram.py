"""Exact least squares and ridge from Gram matrices, for every group and every fold in one pass.

A task adds up the products of its rows in one square block per (group, fold): 1, the columns and the target, less the centre of
the group, so that little cancels. Blocks of all tasks are added by cell. What reaches the driver is the columns squared for
each group and fold, whatever the number of rows; there a Cholesky factor of columns x columns is solved. A model without a fold comes from the
total less the fold's block, and the squared error on the fold from the block itself, so no fold is read again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A column whose share of the scaled matrix falls below this is a combination of the others: its coefficient is 0.
SINGULAR = 1e-12


@dataclass(frozen=True)
class Gram:
    """Sums of products of (1, columns, target) over some rows, less a centre."""

    block: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.block + other.block)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.block - other.block)

    @property
    def rows(self) -> int:
        return round(self.block[0, 0])

    def _centred(self) -> np.ndarray:
        sums = self.block[0, 1:]
        return self.block[1:, 1:] - np.outer(sums, sums) / self.block[0, 0]

    def solve(self, alpha: float = 0.0, width: np.ndarray | None = None) -> np.ndarray:
        """Intercept and coefficients. ``alpha`` times the squared coefficients of the columns divided by ``width`` is added
        to the squared error; the intercept is free. Columns that others make up get 0, the later one first."""
        inner = self._centred()
        size = len(inner) - 1
        matrix, right = inner[:size, :size].copy(), inner[:size, size]
        if alpha:
            matrix[np.diag_indices(size)] += alpha * (np.ones(size) if width is None else width) ** 2
        scale = np.sqrt(np.maximum(np.diag(matrix), 0))
        # Sums of a column that never changes are 0 but for rounding.
        used = [i for i in range(size) if matrix[i, i] > SINGULAR * max(self.block[i + 1, i + 1], 1e-300)]
        matrix = matrix / np.outer(np.where(scale > 0, scale, 1), np.where(scale > 0, scale, 1))
        factor, kept = np.zeros((size, size)), []
        for i in used:
            # One row of the Cholesky factor after the other; a row with nothing of its own is left out.
            row = np.zeros(len(kept))
            for k, j in enumerate(kept):
                row[k] = (matrix[i, j] - row[:k] @ factor[j, :k]) / factor[j, k]
            own = matrix[i, i] - row @ row
            if own > SINGULAR:
                factor[i, : len(kept)] = row
                factor[i, len(kept)] = np.sqrt(own)
                kept.append(i)
        lower = factor[np.ix_(kept, range(len(kept)))]
        half = np.linalg.solve(lower, right[kept] / scale[kept]) if kept else np.zeros(0)
        found = np.zeros(size)
        found[kept] = (np.linalg.solve(lower.T, half) if kept else half) / scale[kept]
        mean = self.block[0, 1:] / self.block[0, 0]
        return np.concatenate([[mean[size] - mean[:size] @ found], found])

    def errors(self, model: np.ndarray) -> tuple[float, float]:
        """RMSE and R² of a model (intercept, coefficients) on these rows."""
        side = np.append(-model, 1.0)
        squares = max(float(side @ self.block @ side), 0.0)
        total = self._centred()[-1, -1]
        return (squares / self.block[0, 0]) ** 0.5, 1 - squares / total if total > 0 else float("nan")


def centres(rows: DataFrame, group: str, columns: Sequence[str], label: str) -> dict:
    """Mean of every column and the target per group: one row each."""
    names = [*columns, label]
    found = rows.groupBy(group).agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(names)]).collect()
    return {r[group]: np.array([r[f"c{i}"] for i in range(len(names))], float) for r in found}


def grams(rows: DataFrame, group: str, fold: str, columns: Sequence[str], label: str, centre: dict) -> dict[tuple, Gram]:
    """The block of every (group, fold). ``rows`` have no missing numbers; groups and folds are whole numbers, few of each."""
    wide = len(columns) + 2
    chosen = rows.select(
        F.col(group).cast("long").alias("group"), F.col(fold).cast("long").alias("fold"),
        *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate([*columns, label])],
    )

    def run(stream):
        blocks: dict[tuple, np.ndarray] = {}
        for batch in stream:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(i)) for i in (0, 1)], axis=1)
            values = np.stack([np.ones(batch.num_rows), *(np.asarray(batch.column(i), dtype=float) for i in range(2, wide + 1))], axis=1)
            for key in np.unique(keys, axis=0):
                part = values[(keys == key).all(axis=1)]
                part[:, 1:] -= centre[int(key[0])]
                name = tuple(key.tolist())
                blocks[name] = blocks.get(name, 0) + part.T @ part
        if blocks:
            names, size = list(blocks), wide * wide
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([n[0] for n in names], size)), pa.array(np.repeat([n[1] for n in names], size)),
                pa.array(np.tile(np.arange(size), len(names))), pa.array(np.concatenate([blocks[n].ravel() for n in names])),
            ], names=["group", "fold", "cell", "part"])

    parts = chosen.mapInArrow(run, "group long, fold long, cell long, part double")
    table = parts.groupBy("group", "fold", "cell").agg(F.sum("part").alias("total")).toArrow().to_pydict()
    found: dict[tuple, np.ndarray] = {}
    for name, number, cell, total in zip(*(table[c] for c in ("group", "fold", "cell", "total"))):
        found.setdefault((name, number), np.zeros(wide * wide))[cell] = total
    return {key: Gram(flat.reshape(wide, wide)) for key, flat in found.items()}


def total(blocks: Iterable[Gram]) -> Gram:
    blocks = list(blocks)
    return sum(blocks[1:], blocks[0])


@dataclass(frozen=True)
class GroupModels:
    """Gram blocks of all groups and folds, and models from them."""

    columns: list[str]
    centre: dict
    blocks: dict[tuple, Gram]
    widths: dict

    def groups(self) -> list:
        return sorted({g for g, _ in self.blocks})

    def whole(self, group) -> Gram:
        return total(b for (g, _), b in self.blocks.items() if g == group)

    def coefficients(self, group, alpha: float = 0.0) -> dict[str, float]:
        """Intercept (under "") and coefficients in the units of the columns."""
        model = self.whole(group).solve(alpha, self.widths.get(group))
        centre = self.centre[group]
        intercept = model[0] + centre[-1] - centre[:-1] @ model[1:]
        return {"": float(intercept)} | dict(zip(self.columns, map(float, model[1:])))

    def folds(self, group, alpha: float = 0.0) -> list[tuple]:
        """(fold, rows learnt from, rows held out, RMSE, R²) of every fold held out once."""
        whole, out = self.whole(group), []
        for (g, fold), held in sorted(self.blocks.items()):
            if g == group:
                learnt = whole - held
                out.append((fold, learnt.rows, held.rows, *held.errors(learnt.solve(alpha, self.widths.get(group)))))
        return out


def group_models(rows: DataFrame, group: str, fold: str, columns: Sequence[str], label: str, widths: dict | None = None) -> GroupModels:
    """Models of every group, with and without each fold, from two scans: centres, then blocks."""
    centre = centres(rows, group, columns, label)
    return GroupModels(list(columns), centre, grams(rows, group, fold, columns, label, centre), widths or {})
