"""Trees whose splits serve the ridge models in their leaves.

Sums of products per node, column and bin tell the error of both sides' ridge models at
every cut, so a level needs the rows once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from .binned import CHUNK_ROWS, SCAN_BYTES, bin_cuts
from .explain import Node
from .gram import column_means

#: Errors closer than this share are equal.
EQUAL = 1e-9

#: (column, low, high) of the rows of a node: low < value <= high.
Path = tuple[tuple[int, float, float], ...]


@dataclass(frozen=True)
class _Task:
    """One column of one node, to be summed between cuts."""

    node: int
    column: int
    path: Path
    cuts: np.ndarray


@dataclass(frozen=True)
class _Cut:
    """A task's best cut, the errors with and without it, and the two bins that meet there."""

    task: _Task
    error: float
    before: float
    value: float
    low: float
    high: float
    near: int


def grow(
    df: DataFrame,
    split_on: Sequence[str],
    xs: Sequence[str],
    y: str,
    max_depth: int,
    alpha: float,
    min_rows: int,
    min_gain: float,
    bins: int,
) -> Node:
    """The tree over the columns ``split_on`` for ridge models of y by xs."""
    centre = column_means(df, [*xs, y])
    column_means(df, split_on)  # refuses missing values
    cuts = bin_cuts(df, split_on, df.count(), bins)
    names = [*[f"s{i}" for i in range(len(split_on))], *[f"x{i}" for i in range(len(xs))], "y"]
    rows = df.select(*[number(c).alias(n) for c, n in zip([*split_on, *xs, y], names)])
    root = Node(1)
    level, paths, whole = [root], {1: ()}, None
    for _ in range(max_depth):
        best: dict[int, list[_Cut]] = {}
        todo = [_Task(node.id, i, paths[node.id], c) for node in level for i, c in enumerate(cuts) if len(c)]
        for task, sums in _products(rows, todo, centre):
            whole = _spread(sums.sum(0)) if whole is None else whole
            found = _best_cut(task, sums, alpha, min_rows)
            if found and found.before - found.error > min_gain * whole:
                best.setdefault(task.node, []).append(found)
        chosen = {}
        for node, found in best.items():
            least = min(f.error for f in found)
            chosen[node] = min((f for f in found if f.error <= least * (1 + EQUAL) + EQUAL * whole), key=lambda f: f.task.column)
        for task, sums in _products(rows, [_finer(rows, f, bins) for f in chosen.values()], centre):
            found, known = _best_cut(task, sums, alpha, min_rows), chosen[task.node]
            if found and found.error < known.error * (1 - EQUAL) - EQUAL * whole:
                chosen[task.node] = found
        following = []
        for node in level:
            if node.id not in chosen:
                continue
            column, t = chosen[node.id].task.column, chosen[node.id].value
            node.feature, node.threshold = split_on[column], t
            node.left, node.right = Node(2 * node.id), Node(2 * node.id + 1)
            paths[2 * node.id] = (*paths[node.id], (column, -np.inf, t))
            paths[2 * node.id + 1] = (*paths[node.id], (column, t, np.inf))
            following += [node.left, node.right]
        level = following
        if not level:
            break
    leaves = [n for n in _preorder(root) if n.feature is None]
    for place, node in enumerate(leaves):
        node.leaf = place
    return root


def _preorder(node: Node) -> Iterator[Node]:
    yield node
    if node.feature is not None:
        yield from _preorder(node.left)
        yield from _preorder(node.right)


def _finer(rows: DataFrame, found: _Cut, bins: int) -> _Task:
    """New cuts in the two bins that meet at the cut found; all else lies in two outer bins."""
    task, name = found.task, f"s{found.task.column}"
    inside = functools.reduce(
        lambda a, b: a & b,
        [(F.col(f"s{i}") > low) & (F.col(f"s{i}") <= high) for i, low, high in (*task.path, (task.column, found.low, found.high))],
    )
    own = bin_cuts(rows.filter(inside), [name], found.near, bins)[0]
    ends = [v for v in (found.low, found.high) if np.isfinite(v)]
    return _Task(task.node, task.column, task.path, np.unique([*ends, *own]))


def _products(rows: DataFrame, todo: Sequence[_Task], centre: np.ndarray) -> Iterator[tuple[_Task, np.ndarray]]:
    """Per task the matrices Z'Z of its bins, in scans of at most ``SCAN_BYTES``."""
    size = len(centre) + 1
    upper = np.triu_indices(size)
    most = max((len(t.cuts) for t in todo), default=0) + 1
    step = max(1, SCAN_BYTES // (8 * most * len(upper[0])))
    for start in range(0, len(todo), step):
        part = todo[start : start + step]
        for r in _scan(rows, part, centre).toLocalIterator():
            task = part[r["at"]]
            flat = np.frombuffer(r["sums"], "f8").reshape(len(task.cuts) + 1, -1)
            sums = np.zeros((len(flat), size, size))
            sums[:, upper[0], upper[1]] = flat
            sums[:, upper[1], upper[0]] = flat
            yield task, sums


def _scan(rows: DataFrame, part: Sequence[_Task], centre: np.ndarray) -> DataFrame:
    """``at, sums``: upper triangles of Z'Z per bin, summed per Spark task, then over them."""
    width = len(rows.columns) - len(centre)
    upper = np.triu_indices(len(centre) + 1)

    def add_chunk(table: pa.Table, sums: dict[int, np.ndarray]) -> None:
        columns = [c.to_numpy() for c in table.columns]
        z = np.column_stack([np.ones(table.num_rows), *columns[width:]])
        z[:, 1:] -= centre
        inside: dict[int, np.ndarray] = {}
        for at, task in enumerate(part):
            if task.node not in inside:
                mask = np.ones(len(z), bool)
                for i, low, high in task.path:
                    mask &= (columns[i] > low) & (columns[i] <= high)
                inside[task.node] = np.flatnonzero(mask)
            own = np.searchsorted(task.cuts, columns[task.column][inside[task.node]], "left")
            order = np.argsort(own, kind="stable")
            if not len(order):
                continue
            n_bins = len(task.cuts) + 1
            ends = np.searchsorted(own[order], np.arange(n_bins + 1))
            total = sums.setdefault(at, np.zeros((n_bins, len(upper[0]))))
            for k in np.flatnonzero(np.diff(ends)):
                block = z[inside[task.node][order[ends[k] : ends[k + 1]]]]
                total[k] += (block.T @ block)[upper]

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        held: list[pa.RecordBatch] = []
        for batch in source:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                add_chunk(pa.Table.from_batches(held), sums)
                held = []
        if held:
            add_chunk(pa.Table.from_batches(held), sums)
        yield from _batches(sums)

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in source:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                flat = np.frombuffer(data.as_py(), "f8")
                sums[at] = sums[at] + flat if at in sums else flat
        yield from _batches(sums)

    schema = "at int, sums binary"
    return rows.mapInArrow(scan, schema).repartition("at").mapInArrow(add, schema)


def _batches(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["at", "sums"]
        )


def _spread(matrix: np.ndarray) -> float:
    return float(matrix[-1, -1] - matrix[0, -1] ** 2 / matrix[0, 0])


def _best_cut(task: _Task, sums: np.ndarray, alpha: float, min_rows: int) -> _Cut | None:
    left = np.cumsum(sums, 0)
    whole, left = left[-1], left[:-1]
    right = whole - left
    n, least = sums[:, 0, 0], max(1, min_rows)
    fits = np.flatnonzero((left[:, 0, 0] >= least) & (right[:, 0, 0] >= least) & (n[:-1] > 0))
    if not len(fits):
        return None
    error = ridge_errors(left[fits], alpha) + ridge_errors(right[fits], alpha)
    best = int(np.flatnonzero(error <= error.min() * (1 + EQUAL) + EQUAL * _spread(whole))[0])
    at, ends = int(fits[best]), [-np.inf, *task.cuts, np.inf]
    before = float(ridge_errors(whole[None], alpha)[0])
    near = int(round(n[at] + n[at + 1]))
    return _Cut(task, float(error[best]), before, float(ends[at + 1]), float(ends[at]), float(ends[at + 2]), near)


def ridge_errors(matrices: np.ndarray, alpha: float) -> np.ndarray:
    """Squared error of the ridge model fitted and judged on the rows of each matrix Z'Z."""
    n = matrices[:, 0, 0]
    means = matrices[:, 0, 1:] / n[:, None]
    spread = matrices[:, 1:, 1:] - n[:, None, None] * means[:, :, None] * means[:, None, :]
    sxx, sxy, syy = spread[:, :-1, :-1], spread[:, :-1, -1], spread[:, -1, -1]
    inverse = np.linalg.pinv(sxx + alpha * np.eye(sxx.shape[1]), hermitian=True)
    b = np.einsum("kij,kj->ki", inverse, sxy)
    error = syy - 2 * np.einsum("ki,ki->k", b, sxy) + np.einsum("ki,kij,kj->k", b, sxx, b)
    return np.maximum(error, 0.0)
