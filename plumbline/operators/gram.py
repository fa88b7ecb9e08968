"""Ridge regression from sums of products, one pass over the rows (L3).

Every fold's cross-product matrix is enough to fit and score any column subset
and any penalty exactly, so the data is read once for a whole search.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number, require

# Wider tables leave code generation; their products are summed as matrices.
NATIVE_WIDTH = 11


@dataclass
class Moments:
    """Per group, the matrix Z'Z of Z = [1, x - centre, y - centre]."""

    xs: list[str]
    centre: np.ndarray
    groups: dict[int, np.ndarray] = field(default_factory=dict)

    def total(self, groups: Sequence[int] | None = None) -> np.ndarray:
        chosen = self.groups if groups is None else groups
        zero = np.zeros((len(self.xs) + 2,) * 2)
        return functools.reduce(np.add, (self.groups[g] for g in chosen if g in self.groups), zero)

    @property
    def n_rows(self) -> int:
        return int(round(self.total()[0, 0]))


def column_means(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Means of the columns; a missing value is an error, as models refuse them."""
    require(df, cols)
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.count(number(c)).alias(f"n{i}") for i, c in enumerate(cols)],
    ).first()
    gaps = [c for i, c in enumerate(cols) if row[f"n{i}"] < row["rows"]]
    if gaps:
        raise ValueError(f"columns {gaps} have missing values; drop or fill them first")
    if not row["rows"]:
        raise ValueError("no rows")
    return np.array([row[f"m{i}"] for i in range(len(cols))])


def group_moments(
    df: DataFrame, xs: Sequence[str], y: str, group: Column | None = None
) -> Moments:
    """Cross products per value of an integer group expression."""
    xs = list(xs)
    centre = column_means(df, [*xs, y])
    group = F.lit(0) if group is None else group
    shifted = [(number(c) - F.lit(float(m))).alias(f"z{i + 1}") for i, (c, m) in enumerate(zip([*xs, y], centre))]
    rows = df.select(group.cast("int").alias("g"), F.lit(1.0).alias("z0"), *shifted)
    summed = _native_sums(rows) if len(xs) <= NATIVE_WIDTH else _matrix_sums(rows)
    out = Moments(xs, centre)
    size = len(xs) + 2
    for r in summed.collect():
        block = np.zeros((size, size))
        block[np.triu_indices(size)] = r["sums"]
        out.groups[r["g"]] = block + np.triu(block, 1).T
    return out


def _native_sums(rows: DataFrame) -> DataFrame:
    z = rows.columns[1:]
    upper = [(a, b) for i, a in enumerate(z) for b in z[i:]]
    return (
        rows.groupBy("g")
        .agg(*[F.sum(F.col(a) * F.col(b)).alias(f"s{k}") for k, (a, b) in enumerate(upper)])
        .select("g", F.array(*[F.col(f"s{k}") for k in range(len(upper))]).alias("sums"))
    )


def _matrix_sums(rows: DataFrame) -> DataFrame:
    """Matrix products per Arrow batch, added up per partition, then per group.

    A task sends one array per group, not a row per cell.
    """
    width = len(rows.columns) - 1
    upper = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            z = np.column_stack(
                [batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(width)]
            )
            for g in np.unique(groups):
                part = z[groups == g]
                sums[int(g)] = sums.get(int(g), 0.0) + (part.T @ part)[upper]
        yield from _sums_batch(sums)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for g, flat in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[g] = sums.get(g, 0.0) + flat.values.to_numpy()
        yield from _sums_batch(sums)

    schema = "g int, sums array<double>"
    return rows.mapInArrow(products, schema).repartition("g").mapInArrow(added, schema)


def _sums_batch(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per group; groups are few and their matrices small next to the rows."""
    for g, flat in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([g], pa.int32()), pa.array([flat], pa.list_(pa.float64()))], names=["g", "sums"]
        )


def solve(
    matrix: np.ndarray, picks: Sequence[int], alpha: float, scaled: Sequence[int] = ()
) -> np.ndarray:
    """Coefficients [intercept, b...] on the centred columns ``picks`` (1-based).

    The intercept is not penalized. Columns in ``scaled`` are penalized as if
    standardized on these same rows.
    """
    idx = np.array(picks, dtype=int)
    n = matrix[0, 0]
    means = matrix[0, idx] / n
    y_mean = matrix[0, -1] / n
    sxx = matrix[np.ix_(idx, idx)] - n * np.outer(means, means)
    sxy = matrix[idx, -1] - n * means * y_mean
    spread = np.diag(sxx) / n
    weight = np.where(np.isin(idx, list(scaled)) & (spread > 1e-300), spread, 1.0)
    b = np.linalg.lstsq(sxx + alpha * np.diag(weight), sxy, rcond=None)[0]
    return np.concatenate([[y_mean - means @ b], b])


def scores_from_moments(
    train: np.ndarray,
    test: np.ndarray,
    picks: Sequence[int],
    alpha: float,
    scaled: Sequence[int] = (),
) -> dict[str, float | None]:
    """mse and r2 on the test rows of the model fitted on the train rows."""
    if test[0, 0] == 0 or train[0, 0] == 0:
        return {"mse": None, "r2": None}
    coef = solve(train, picks, alpha, scaled)
    v = np.zeros(test.shape[0])
    v[0], v[list(picks)], v[-1] = -coef[0], -coef[1:], 1.0
    n = test[0, 0]
    sse = max(float(v @ test @ v), 0.0)
    sst = test[-1, -1] - test[0, -1] ** 2 / n
    return {"mse": float(sse / n), "r2": None if sst <= 0 else float(1.0 - sse / sst)}


@dataclass
class Ridge:
    """Linear model with an L2 penalty ``alpha`` on the summed squared error."""

    alpha: float = 1.0
    xs: list[str] = field(default_factory=list)
    coef: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def fit(self, df: DataFrame, xs: Sequence[str], y: str) -> Ridge:
        return self.from_moments(group_moments(df, xs, y))

    def from_moments(self, moments: Moments) -> Ridge:
        xs = moments.xs
        b = solve(moments.total(), range(1, len(xs) + 1), self.alpha)
        centre = moments.centre
        self.xs = xs
        self.coef = dict(zip(xs, map(float, b[1:])))
        self.intercept = float(b[0] + centre[-1] - centre[:-1] @ b[1:])
        return self

    def prediction(self) -> Column:
        return functools.reduce(
            lambda total, c: total + number(c) * F.lit(self.coef[c]), self.xs, F.lit(self.intercept)
        )

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction())

    def table(self, df: DataFrame) -> DataFrame:
        """(term, value) of the fitted model."""
        rows = [("intercept", self.intercept), *self.coef.items()]
        return df.sparkSession.createDataFrame(rows, "term string, value double")
