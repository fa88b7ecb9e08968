"""Maximal information between a column and the target, over unequal grids.

A grid cuts one side into bins of about equal counts and the other wherever it pays
most. Rows are counted once, on a fine grid per pair of columns; a dynamic program over the
fine bins then finds the best cuts for every number of bins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, number, require
from ..spec import TableSpec
from .binned import CHUNK_ROWS, bin_cuts

#: Columns whose cuts are taken in one scan.
CUT_COLUMNS = 64


def grid_size(n: int, power: float) -> int:
    """Largest number of cells of a grid over n rows."""
    return max(4, int(n**power + 1e-9))


def maximal_information(
    df: DataFrame, cols: Sequence[str], target: str, power: float = 0.3, fineness: int = 5
) -> DataFrame:
    """(variable, n, score, bins_x, bins_y): the best normalized mutual information of a grid.

    All grids of at most ``n ** power`` cells count, 4 at least, n being the rows that have both
    values. One side has bins of about equal counts, the other up to ``fineness`` fine
    bins for each bin it may have, joined in the best way. The score is the information
    divided by the logarithm of the smaller number of bins: 0 without relation, 1 for a function
    without noise. Equal scores go to the grid with fewer cells, then fewer bins of x. A column
    or target with one value has score 0 and one bin; a column without rows has null.

    The fine grid has some ``(fineness / 2 * n ** power) ** 2`` cells per column, whatever the
    rows; one task holds those of one column.
    """
    cols = require(df, cols)
    require(df, [target])
    names = [*cols, target]
    n_rows = df.count()
    bins = fineness * (grid_size(n_rows, power) // 2)
    cuts = [
        c
        for start in range(0, len(names), CUT_COLUMNS)
        for c in bin_cuts(df, names[start : start + CUT_COLUMNS], n_rows, bins)
    ]
    cells = _cells(df, names, cuts).groupBy("i", "x", "y").agg(F.sum("n").alias("n"))

    def best(group: pd.DataFrame) -> pd.DataFrame:
        x, y, n = (group[c].to_numpy() for c in "xyn")
        score, p, q = best_grid(x, y, n, grid_size(int(n.sum()), power), fineness)
        return pd.DataFrame({"i": [group["i"].iloc[0]], "n": [n.sum()], "score": [score], "bins_x": [p], "bins_y": [q]})

    found = cells.groupBy("i").applyInPandas(best, "i int, n long, score double, bins_x int, bins_y int")
    labels = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, variable string")
    return labels.join(found, "i", "left").select(
        "variable", F.coalesce("n", F.lit(0)).alias("n"), "score", "bins_x", "bins_y"
    )


def drop_uninformative(df: DataFrame, spec: TableSpec, least: float = 0.1, power: float = 0.3) -> DataFrame:
    """The frame without numeric predictors whose maximal information is below ``least``."""
    found = maximal_information(df, spec.numerics(df), spec.target, power)
    poor = [r["variable"] for r in found.collect() if r["score"] is None or r["score"] < least]
    return df.select(*[col(c) for c in df.columns if c not in poor])


def _cells(df: DataFrame, names: Sequence[str], cuts: Sequence[np.ndarray]) -> DataFrame:
    """``i, x, y, n``: rows per fine cell of column i and the target, summed per chunk of rows."""
    width = len(cuts[-1]) + 1

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(source):
            y = table.column(len(names) - 1).to_numpy()
            y_bin = np.searchsorted(cuts[-1], y, "left")
            for i in range(len(names) - 1):
                x = table.column(i).to_numpy()
                both = ~(np.isnan(x) | np.isnan(y))
                place = np.searchsorted(cuts[i], x[both], "left") * width + y_bin[both]
                cell, n = np.unique(place, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(cell), i, "i4")),
                        pa.array((cell // width).astype("i4")),
                        pa.array((cell % width).astype("i4")),
                        pa.array(n.astype("i8")),
                    ],
                    names=["i", "x", "y", "n"],
                )

    values = df.select(*[number(c).alias(f"v{i}") for i, c in enumerate(names)])
    return values.mapInArrow(count, "i int, x int, y int, n long")


def _chunks(source: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, joined to tables of about ``CHUNK_ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in source:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def best_grid(x: np.ndarray, y: np.ndarray, n: np.ndarray, size: int, fineness: int) -> tuple[float, int, int]:
    """(score, bins of x, bins of y) of the best grid of at most ``size`` cells."""
    found = [(0.0, 1, 1)]
    for even, free, turned in ((y, x, False), (x, y, True)):
        for q in range(2, min(size // 2, len(np.unique(even))) + 1):
            rows = _even_bins(even, n, q)
            n_rows = int(rows.max()) + 1
            if n_rows < 2:  # one value holds nearly all rows
                continue
            clumps = _even_bins(free, n, fineness * (size // q))
            table = np.zeros((int(clumps.max()) + 1, n_rows))
            np.add.at(table, (clumps, rows), n)
            for p, info in _best_cuts(_clumps(table), size // q):
                score = round(info / np.log(min(p, n_rows)), 12)
                found.append((score, n_rows, p) if turned else (score, p, n_rows))
    return max(found, key=lambda f: (f[0], -f[1] * f[2], -f[1]))


def _even_bins(fine: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each cell: fine bins joined to at most ``bins`` of about equal counts, numbered from 0."""
    own, at = np.unique(fine, return_inverse=True)
    if len(own) <= bins:
        return at
    mass = np.bincount(at, n)
    middle = (np.cumsum(mass) - mass / 2) / mass.sum()
    return np.unique((middle * bins).astype("i8"), return_inverse=True)[1][at]


def _clumps(table: np.ndarray) -> np.ndarray:
    """Neighbouring rows of the table joined where both have all counts in the same one column."""
    pure = np.where((table > 0).sum(1) == 1, table.argmax(1), -1)
    new = np.concatenate([[True], (pure[1:] != pure[:-1]) | (pure[1:] < 0)])
    return np.add.reduceat(table, np.flatnonzero(new), axis=0)


def _best_cuts(table: np.ndarray, most: int) -> Iterator[tuple[int, float]]:
    """(p, information) for the best p intervals of the table's rows, p from 2 to ``most``."""
    total, size = table.sum(), len(table)
    cumulated = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table, 0)])
    # worth[s, t]: sum of n log(n / all) inside the interval of rows s .. t - 1.
    worth = np.full((size + 1, size + 1), -np.inf)
    for s in range(size):
        inside = cumulated[s + 1 :] - cumulated[s]
        whole = inside.sum(1)
        worth[s, s + 1 :] = _n_log_n(inside).sum(1) - _n_log_n(whole)
    base = np.log(total) - _n_log_n(table.sum(0)).sum() / total
    best = worth[0]
    for p in range(2, min(most, size) + 1):
        best = (best[:, None] + worth).max(0)
        yield p, max(0.0, base + best[size] / total)


def _n_log_n(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.where(n > 0, n, 1.0))
