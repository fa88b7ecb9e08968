"""Kernel regression with a band of no loss (L5), trained by passes over the rows.

The objective is |w|^2 / 2 + C * sum(max(0, |y - w.z - b| - epsilon)) over random Fourier
features z, which tasks make from the raw columns. The bend at the band's edge is rounded off
over a width that falls from pass to pass; a pass sums the gradient and two curvatures, another
tries steps along both directions at once. Rows inside the band add nothing to either.
Equal rows are counted first and add their sums as often; few of them need no more scans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from ..staging import staged
from .boosting import _added, _slots, spread_out
from .binned import CHUNK_ROWS
from .cells import MAX_CELLS, counted

#: Widths of the rounded edge, as shares of the target's spread.
WIDTHS = tuple(0.25**k for k in range(7))
STEPS = tuple(0.5**k for k in range(12))
#: Sums that reach the driver from one pass.
PARTS = 64
#: Distinct rows up to which passes run in the driver.
HERE_ROWS = 1 << 14
#: Rows whose features a task makes at once.
BLOCK = 8_192


@dataclass
class TubeModel:
    weights: np.ndarray
    intercept: float

    def transform(self, df: DataFrame, features: str = "_features") -> DataFrame:
        terms = F.zip_with(vector_to_array(features), F.array(*map(F.lit, map(float, self.weights))), lambda z, w: z * w)
        return df.withColumn("prediction", F.aggregate(terms, F.lit(self.intercept), lambda a, v: a + v))


@dataclass(frozen=True)
class EpsilonTube:
    """``C``, ``epsilon`` and the most passes of ``params``; ``tol`` is the least relative gain of a pass."""

    params: dict
    tol: float = 1e-6

    def fit(self, df: DataFrame, xs: Sequence[str], label: Column, n_rows: int, project: tuple[np.ndarray, ...]) -> TubeModel:
        """``project``: weights and shifts of the features, and their scale."""
        rows = df.select(label.cast("double").alias("y"), *[number(x).alias(f"x{i}") for i, x in enumerate(xs)])
        size = len(project[1])
        middle, spread = rows.agg(F.avg("y"), F.stddev_pop("y")).first()
        equal = counted(rows, min(MAX_CELLS, n_rows // 2))
        table = spread_out(rows, n_rows).withColumn("_n", F.lit(1)) if equal is None else equal
        with staged(table, "tube") as table:
            at = np.append(np.zeros(size), 0.0 if middle is None else middle)
            if not spread:
                return TubeModel(at[:-1], float(at[-1]))
            passes = _Passes(table, n_rows, project, float(self.params["C"]), float(self.params["epsilon"]))
            left = int(self.params["max_iter"])
            for width in WIDTHS:
                value = None
                while left > 0:
                    left -= 1
                    now, gradient, newton, upper = passes.slopes(at, width * spread)
                    value = now if value is None else value
                    tries = np.array([at - t * np.linalg.solve(m, gradient) for m in (newton, upper) for t in STEPS])
                    values = passes.values(tries, width * spread)
                    best = int(values.argmin())
                    if not values[best] < now - self.tol * abs(now):
                        if values[best] < now:
                            at = tries[best]
                        break
                    at = tries[best]
        return TubeModel(at[:-1], float(at[-1]))


class _Passes:
    def __init__(self, table: DataFrame, n_rows: int, project: tuple, c: float, epsilon: float):
        self.table, self.n_rows, self.project, self.c, self.epsilon = table, n_rows, project, c, epsilon
        few = table.limit(HERE_ROWS + 1).toArrow()
        self.here = None
        if few.num_rows <= HERE_ROWS:
            few = few.sort_by([(c, "ascending") for c in few.column_names])
            self.here = few.combine_chunks().to_batches(BLOCK) if few.num_rows else []

    def _sums(self, add: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """``add(features, target, number)`` of all blocks, summed."""
        weights, shift, scale = self.project

        def added(source: Iterable[pa.RecordBatch]) -> np.ndarray | None:
            total = None
            for batch in source:
                columns = [c.to_numpy(zero_copy_only=False).astype("f8") for c in batch.columns]
                if any(np.isnan(c).any() for c in columns):
                    raise ValueError("missing values in the rows of the kernel regressor")
                for first in range(0, batch.num_rows, BLOCK):
                    y, *x, n = (c[first : first + BLOCK] for c in columns)
                    z = np.empty((len(y), len(shift) + 1))
                    z[:, -1] = 1.0
                    z[:, :-1] = scale * np.cos(np.column_stack(x) @ weights.T + shift)
                    part = add(z, y, n)
                    total = part if total is None else total + part
            return total

        if self.here is not None:
            return added(self.here)

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = added(source)
            if total is not None:
                yield from _slots({TaskContext.get().partitionId() % PARTS: total})

        found = self.table.mapInArrow(run, "slot int, sums binary")
        if self.n_rows > PARTS * CHUNK_ROWS:
            found = found.repartition(PARTS, "slot").mapInArrow(_added, "slot int, sums binary")
        # In the order of the slots, so that a repeated pass adds up alike.
        rows = sorted(found.collect(), key=lambda r: (r["slot"], r["sums"]))
        return np.sum([np.frombuffer(r["sums"], "f8") for r in rows], axis=0)

    def slopes(self, at: np.ndarray, width: float) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Objective, gradient, curvature, and a curvature that bounds the rows outside from above."""
        epsilon, size = self.epsilon, len(at)

        def add(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
            gap = z @ at - y
            out = np.abs(gap) - epsilon
            rows = out > 0
            z, out, side, n = z[rows], out[rows], np.sign(gap[rows]), n[rows]
            near = out < width
            slope = n * np.minimum(out / width, 1.0)
            loss = (n * np.where(near, out**2 / (2 * width), out - width / 2)).sum()
            upper = z * (slope / np.maximum(out, 1e-300))[:, None]
            newton = z[near] * (n[near] / width)[:, None]
            return np.concatenate([[loss], z.T @ (side * slope), (newton.T @ z[near]).ravel(), (upper.T @ z).ravel()])

        sums = self.c * self._sums(add)
        loss, gradient, newton, upper = np.split(sums, np.cumsum([1, size, size * size]))
        pull = np.append(np.ones(size - 1), 0.0)
        floor = np.diag(np.append(np.ones(size - 1), 1e-9 * (1.0 + self.c * self.n_rows)))
        value = float(loss[0] + (pull * at**2).sum() / 2)
        return value, gradient + pull * at, newton.reshape(size, size) + floor, upper.reshape(size, size) + floor

    def values(self, tries: np.ndarray, width: float) -> np.ndarray:
        """The objective at several places."""
        epsilon = self.epsilon

        def add(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
            out = np.maximum(np.abs(z @ tries.T - y[:, None]) - epsilon, 0.0)
            return n @ np.where(out < width, out**2 / (2 * width), out - width / 2)

        return self.c * self._sums(add) + (tries[:, :-1] ** 2).sum(1) / 2
