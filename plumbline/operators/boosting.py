"""Boosted trees grown best leaf first, for many models in the same scans.

A split of a leaf does not depend on the other leaves. So a scan counts the gradients of all
leaves of one depth, for every model and class at once, and the best-first order with its
limit of leaves is played through on the gains known so far: a leaf that this order does not
reach is not counted. A round costs as many scans as its trees are deep, whatever the number of
models. Gradients are rounded to multiples of a unit so small in number that every sum of them
is exact: the trees depend on the rows, not on their layout.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, number
from ..staging import delete_folder, new_path
from .binned import CHUNK_ROWS, SCAN_BYTES, bin_cuts

BINS = 255
#: Rounds whose trees are applied again in each scan before the margins are written.
ROUNDS_HELD = 8
#: Rows for which a task of its own pays.
TASK_ROWS = 8_192
#: Least sum of second derivatives on either side of a split.
MIN_HESSIAN = 1e-3
#: Combinations of bins up to which a model is asked for each before it predicts rows.
GRID_CELLS = 1 << 18
#: Trees that one call of ``boost`` grows side by side; callers with more take several.
SIDE_BY_SIDE = 64


@dataclass
class Tree:
    """Nodes by number; an inner node sends bins up to ``cut`` of ``feature`` to the left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    depth: int = 0

    def add(self) -> int:
        self.feature.append(-1)
        for name in ("cut", "left", "right"):
            getattr(self, name).append(0)
        self.value.append(0.0)
        self.gain.append(0.0)
        return len(self.feature) - 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), "i8")
        rows = np.arange(len(bins))
        feature, cut, left, right = map(np.asarray, (self.feature, self.cut, self.left, self.right))
        for _ in range(self.depth):
            f = feature[at]
            low = bins[rows, np.maximum(f, 0)] <= cut[at]
            at = np.where(f >= 0, np.where(low, left[at], right[at]), at)
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(bins)]


class GridModel:
    """What a model of binned columns needs to predict: its ``cuts`` and ``predicted(bins)``."""

    cuts: list[np.ndarray]

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def transform(self, df: DataFrame, xs: Sequence[str]) -> DataFrame:
        """The rows with ``prediction``; a missing value of a predictor raises.

        If the columns' bins have few combinations, each is predicted once and rows look theirs up.
        """
        if not xs:
            return df.withColumn("prediction", F.lit(float(self.predicted(np.zeros((1, 0), "i2"))[0])))
        cuts, sizes = self.cuts, tuple(len(c) + 1 for c in self.cuts)
        if math.prod(sizes) <= GRID_CELLS:
            grid = self.predicted(np.indices(sizes, "i2").reshape(len(sizes), -1).T)

            def of(bins: np.ndarray) -> np.ndarray:
                return grid[np.ravel_multi_index(tuple(bins.T), sizes)]

        else:
            of = self.predicted

        @F.pandas_udf("double")
        def said(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for part in columns:
                yield pd.Series(of(_bins([c.to_numpy() for c in part[: len(cuts)]], cuts)))

        # The iterator of one column comes bare; a constant keeps tuples for any number.
        return df.withColumn("prediction", said(*[number(x) for x in xs], F.lit(0.0)))


@dataclass
class Booster(GridModel):
    """One model: what it learns from, and its trees, a list per round with one tree per output.

    ``train`` holds the groups it learns from; None stands for all rows.
    """

    params: dict
    seed: int
    cuts: list[np.ndarray]
    n_classes: int
    train: frozenset[int] | None = None
    start: np.ndarray = field(default_factory=lambda: np.zeros(1))
    rounds: list[list[Tree]] = field(default_factory=list)

    @property
    def outputs(self) -> int:
        return self.n_classes if self.n_classes > 2 else 1

    @property
    def featureImportances(self) -> DenseVector:
        """Each column's share of the gain of all splits."""
        total = np.zeros(len(self.cuts))
        for tree in (t for r in self.rounds for t in r):
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    total[f] += gain
        return DenseVector(total / total.sum() if total.sum() else total)

    def margins(self, bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """Sums of the trees' values, on top of the start or of margins already known."""
        out = np.tile(self.start, (len(bins), 1)) if start is None else start.copy()
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += tree.values(bins)
        return out

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        """The value, or the number of the likeliest class."""
        out = self.margins(bins)
        if not self.n_classes:
            return out[:, 0]
        return (out.argmax(1) if self.n_classes > 2 else out[:, 0] > 0).astype("f8")

    def begin_classes(self, counts: np.ndarray) -> None:
        """The start: the logarithms of the classes' shares."""
        shares = counts / counts.sum()
        if self.n_classes > 2:
            self.start = np.log(shares)
        else:
            self.start = np.log(shares[1:] / shares[:1]) if self.n_classes == 2 else np.array([-50.0])


def _bins(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty((len(columns[0]), len(cuts)), "i2")
    for f, (own, at) in enumerate(zip(columns, cuts)):
        if np.isnan(own).any():
            raise ValueError("missing values in the predictors of boosted trees")
        out[:, f] = np.searchsorted(at, own, "left")
    return out


# ---- tables --------------------------------------------------------------------


def binned_rows(
    df: DataFrame, xs: Sequence[str], label: Column, group: Column, place: Column, cuts: Sequence[np.ndarray]
) -> DataFrame:
    """``g, y, h, bins``: group, label, what subsampling hashes, and the bin of each column."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.column(1).null_count:
                raise ValueError("missing values in the target of boosted trees")
            own = [c.to_numpy(zero_copy_only=False).astype("f8") for c in batch.columns[3:]]
            bins = _bins(own, cuts) if own else np.empty((batch.num_rows, 0), "i2")
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists(bins, pa.int16())], names=["g", "y", "h", "bins"])

    rows = df.select(
        group.cast("int").alias("g"), label.cast("double").alias("y"), place.cast("long").alias("h"),
        *[number(x).alias(f"x{i}") for i, x in enumerate(xs)],
    )
    return rows.mapInArrow(run, "g int, y double, h long, bins array<short>")


def spread_out(rows: DataFrame, n_rows: int) -> DataFrame:
    """Few rows are dealt to as many cores as they are worth; the parts of a large table stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(min(cores, 1 + n_rows // TASK_ROWS)) if n_rows < cores * CHUNK_ROWS else rows


def _lists(table: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * width), pa.array(table.ravel(), kind))


def _matrix(column: pa.Array, n: int, kind: str) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(n, len(flat) // n if n else 0)


def _kept(h: np.ndarray, model: Booster, at: int) -> np.ndarray:
    """Which rows this round learns from: a hash of the row, the round and the seed."""
    share = float(model.params["subsample"])
    if share >= 1.0:
        return np.ones(len(h), bool)
    salt = (at * 0x9E3779B97F4A7C15 + model.seed * 0xD1B54A32D192ED03 + 1) % (1 << 64)
    mixed = h.view("u8") ^ np.uint64(salt)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(factor)
    return (mixed >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def _gradients(y: np.ndarray, margin: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the squared error or the log loss, per output."""
    if not n_classes:
        return margin - y[:, None], np.ones_like(margin)
    if n_classes <= 2:
        p = 1.0 / (1.0 + np.exp(-margin))
        return p - y[:, None], p * (1.0 - p)
    p = np.exp(margin - margin.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    hot = y[:, None] == np.arange(n_classes)
    return p - hot, p * (1.0 - p) * n_classes / (n_classes - 1.0)


# ---- growing -------------------------------------------------------------------


class _Growing:
    """A tree while it grows: sums of each node, and the best split of those already counted."""

    def __init__(self, params: dict, rng_key: list[int]):
        self.params, self.rng_key = params, rng_key
        self.tree = Tree()
        self.tree.add()
        self.sums: dict[int, np.ndarray] = {}
        self.level = {0: 0}
        self.split: dict[int, tuple[float, int, int, np.ndarray]] = {}
        self.open = [0]

    def score(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        top = np.maximum(np.abs(g) - self.params["reg_alpha"], 0.0) ** 2
        below = h + self.params["reg_lambda"]
        return np.divide(top, below, out=np.zeros_like(top), where=below > 0)

    def count(self, node: int, hist: np.ndarray) -> None:
        """Choose the node's split from its histogram, (gradient, hessian, rows) x columns x bins."""
        left = np.cumsum(hist, axis=2)
        whole = left[:, :, -1:]
        right = whole - left
        if node not in self.sums:
            self.sums[node] = whole[:, 0, 0]
        least = max(1, int(self.params["min_child_samples"]))
        fits = (left[2] >= least) & (right[2] >= least) & (left[1] >= MIN_HESSIAN) & (right[1] >= MIN_HESSIAN)
        if self.params.get("extra_trees"):
            # One cut per column, drawn between its first and last filled bin.
            filled = hist[2] > 0
            low = filled.argmax(1)
            high = filled.shape[1] - 1 - filled[:, ::-1].argmax(1)
            draw = np.random.default_rng([*self.rng_key, node]).random(len(low))
            drawn = low + np.floor(draw * (high - low)).astype(int)
            fits &= np.arange(filled.shape[1]) == drawn[:, None]
        parts = self.score(left[0], left[1]) + self.score(right[0], right[1])
        gain = np.where(fits, parts - self.score(whole[0], whole[1]), -1.0)
        at = int(gain.argmax())
        f, cut = divmod(at, gain.shape[1])
        if gain[f, cut] > 1e-10 * parts[f, cut]:
            self.split[node] = (float(gain[f, cut]), f, cut, left[:, f, cut])

    def reached(self) -> list[int]:
        """Nodes split by the best-first order, among the splits known so far."""
        heap = [(-self.split[0][0], 0)] if 0 in self.split else []
        done = []
        while heap and len(done) < int(self.params["num_leaves"]) - 1:
            _, node = heapq.heappop(heap)
            done.append(node)
            if self.tree.feature[node] >= 0:
                for child in (self.tree.left[node], self.tree.right[node]):
                    if child in self.split:
                        heapq.heappush(heap, (-self.split[child][0], child))
        return done

    def deepen(self) -> None:
        """Split the reached nodes of the last level; their children are counted next."""
        tree, counted, self.open = self.tree, set(self.open), []
        limit, least = int(self.params["max_depth"]), 2 * max(1, int(self.params["min_child_samples"]))
        for node in sorted(n for n in self.reached() if n in counted):
            _, tree.feature[node], tree.cut[node], left = self.split[node]
            for side, sums in (("left", left), ("right", self.sums[node] - left)):
                child = tree.add()
                getattr(tree, side)[node] = child
                self.sums[child], self.level[child] = sums, self.level[node] + 1
                tree.depth = max(tree.depth, self.level[child])
                if (limit < 1 or self.level[child] < limit) and sums[2] >= least:
                    self.open.append(child)

    def finish(self) -> Tree:
        """The tree of the best-first order, with the values of its leaves."""
        kept, old, p = set(self.reached()), self.tree, self.params
        tree = Tree()

        def copy(node: int) -> int:
            at = tree.add()
            if node in kept:
                tree.gain[at], tree.feature[at], tree.cut[at] = self.split[node][:3]
                tree.left[at], tree.right[at] = copy(old.left[node]), copy(old.right[node])
                tree.depth = max(tree.depth, self.level[node] + 1)
            elif node in self.sums:
                g, h = self.sums[node][:2]
                if h + p["reg_lambda"] > 0:
                    pull = math.copysign(max(abs(g) - p["reg_alpha"], 0.0), g)
                    tree.value[at] = -float(p["learning_rate"] * pull / (h + p["reg_lambda"]))
            return at

        copy(0)
        return tree


class _Scans:
    """The binned rows, their margins as last written, and the trees since then."""

    def __init__(self, table: DataFrame, models: Sequence[Booster], unit: float, n_rows: int):
        self.base, self.models, self.unit = table, models, unit
        self.table, self.path, self.since = table, None, 0
        self.tasks = 1 + n_rows // CHUNK_ROWS
        self.offsets = np.cumsum([0, *[m.outputs for m in models]])

    def _recent(self) -> list[Booster]:
        """The models with their last rounds alone: what a task needs beside the written margins."""
        return [replace(m, cuts=[], rounds=m.rounds[self.since :]) for m in self.models]

    def _margins(self):
        """A function of a chunk: the margins of one model on chosen rows, before this round."""
        models, offsets, written = self._recent(), self.offsets, self.path is not None

        def margins(m: int, bins: np.ndarray, held: np.ndarray | None, rows) -> np.ndarray:
            start = held[rows, offsets[m] : offsets[m + 1]] if written else None
            return models[m].margins(bins[rows], start)

        return margins

    def histograms(self, growing: dict[tuple[int, int], _Growing], at: int) -> None:
        """Count all open nodes, in as few scans as their size allows."""
        n_features = len(self.models[0].cuts)
        bins = max(len(c) for c in self.models[0].cuts) + 1
        shape = (3, n_features, bins)
        slots = [(key, node) for key, g in growing.items() for node in g.open]
        step = max(1, SCAN_BYTES // (8 * int(np.prod(shape))))
        for first in range(0, len(slots), step):
            part = slots[first : first + step]
            found = self._scan({key: g.tree for key, g in growing.items()}, part, shape, at)
            if self.tasks * len(part) * 8 * int(np.prod(shape)) > SCAN_BYTES:
                found = found.repartition("slot").mapInArrow(_added, "slot int, sums binary")
            total: dict[int, np.ndarray] = {}
            for r in found.toLocalIterator() if self.tasks > 64 else found.collect():
                own = np.frombuffer(r["sums"], "f8").reshape(shape)
                total[r["slot"]] = total[r["slot"]] + own if r["slot"] in total else own
            for slot, (key, node) in enumerate(part):
                growing[key].count(node, total.get(slot, np.zeros(shape)))

    def _scan(self, trees: dict[tuple[int, int], Tree], slots: list, shape: tuple, at: int) -> DataFrame:
        models, unit, margins = self._recent(), self.unit, self._margins()
        _, n_features, n_bins = shape
        wanted: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for slot, ((m, k), node) in enumerate(slots):
            wanted.setdefault(m, {}).setdefault(k, []).append((node, slot))

        def count(g, y, h, bins, held, sums) -> None:
            for m, outputs in wanted.items():
                model = models[m]
                inside = np.isin(g, list(model.train)) if model.train is not None else np.ones(len(g), bool)
                rows = np.flatnonzero(inside & _kept(h, model, at))
                if not len(rows):
                    continue
                own = bins[rows]
                first, second = _gradients(y[rows], margins(m, bins, held, rows), model.n_classes)
                for k, nodes in outputs.items():
                    tree = trees[m, k]
                    local = np.full(len(tree.feature), -1)
                    local[[node for node, _ in nodes]] = np.arange(len(nodes))
                    node_at = local[tree.leaf_of(own)]
                    chosen = np.flatnonzero(node_at >= 0)
                    parts = (np.rint(first[chosen, k] / unit) * unit, second[chosen, k], None)
                    if model.n_classes:  # the others' are whole numbers
                        parts = (parts[0], np.rint(parts[1] / unit) * unit, None)
                    total = np.zeros((3, n_features, len(nodes) * n_bins))
                    for f in range(n_features):
                        cell = node_at[chosen] * n_bins + own[chosen, f]
                        for i, weight in enumerate(parts):
                            total[i, f] = np.bincount(cell, weight, len(nodes) * n_bins)
                    total = total.reshape(3, n_features, len(nodes), n_bins)
                    for i, (_, slot) in enumerate(nodes):
                        sums[slot] = sums[slot] + total[:, :, i] if slot in sums else total[:, :, i]

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for chunk in _chunks(source):
                count(*chunk, sums)
            yield from _slots(sums)

        return self.table.mapInArrow(run, "slot int, sums binary")

    def write(self) -> None:
        """Write the margins of all models, so that later scans need not apply these rounds."""
        margins, n_models = self._margins(), len(self.models)

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g, y, h, bins, held in _chunks(source):
                everything = slice(None)
                found = np.concatenate([margins(m, bins, held, everything) for m in range(n_models)], axis=1)
                columns = [pa.array(g, pa.int32()), pa.array(y), pa.array(h), _lists(bins, pa.int16()), _lists(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["g", "y", "h", "bins", "margins"])

        spark, old, path = self.base.sparkSession, self.path, new_path(self.base.sparkSession, "margins")
        schema = "g int, y double, h long, bins array<short>, margins array<double>"
        self.table.mapInArrow(run, schema).write.parquet(path)
        self.table, self.path = spark.read.schema(schema).parquet(path), path
        self.since = max(len(m.rounds) for m in self.models)
        if old:
            delete_folder(spark, old)

    def close(self) -> None:
        if self.path:
            delete_folder(self.base.sparkSession, self.path)


def _chunks(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Columns of about ``CHUNK_ROWS`` rows at a time."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        n = batch.num_rows
        g, y, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        margins = _matrix(batch.column(4), n, "f8") if batch.num_columns > 4 else None
        return g, y, h, _matrix(batch.column(3), n, "i2"), margins

    for batch in source:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS:
            yield joined()
            held.clear()
    if held:
        yield joined()


def _slots(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for slot, total in sums.items():
        data = np.ascontiguousarray(total).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([data], pa.binary())], names=["slot", "sums"])


def _added(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in source:
        for slot, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.frombuffer(data.as_py(), "f8")
            sums[slot] = sums[slot] + own if slot in sums else own
    yield from _slots(sums)


def _starts(table: DataFrame, models: Sequence[Booster]) -> tuple[int, float]:
    """Set each model's first margins; rows in all, and the largest distance of a target from a start.

    The start is the mean of the target, or the logarithms of the classes' shares.
    """
    n_classes = models[0].n_classes
    if n_classes:
        rows = table.groupBy("g", "y").agg(F.count(F.lit(1)).alias("n")).collect()
        n_rows = sum(r["n"] for r in rows)
        for m in models:
            counts = np.full(n_classes, 1e-9)
            for r in rows:
                if m.train is None or r["g"] in m.train:
                    counts[int(r["y"])] += r["n"]
            m.begin_classes(counts)
        return n_rows, 1.0
    parts = table.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.min("y").alias("low"), F.max("y").alias("high")
    ).collect()
    for m in models:
        own = [r for r in parts if m.train is None or r["g"] in m.train]
        n = sum(r["n"] for r in own)
        # Digits that do not depend on the order of the sum.
        m.start = np.array([float(f"{math.fsum(r['s'] for r in own) / n:.11e}") if n else 0.0])
    spread = max([abs(v - m.start[0]) for m in models for r in parts for v in (r["low"], r["high"])], default=1.0)
    return sum(r["n"] for r in parts), float(spread) or 1.0


def unit_of(spread: float, n_rows: int) -> float:
    """What gradients are multiples of: a sum of all rows' stays below 2^53 units, so it is exact."""
    bits = max(1, min(30, 51 - math.ceil(math.log2(n_rows + 1))))
    return 2.0 ** (math.ceil(math.log2(spread)) - bits)


def boost(table: DataFrame, models: Sequence[Booster]) -> list[Booster]:
    """Train the models side by side on ``binned_rows``; they share cuts and classes."""
    models = list(models)
    n_rows, spread = _starts(table, models)
    if not models[0].cuts or not n_rows:
        return models
    unit = unit_of(spread, n_rows)
    scans = _Scans(table, models, unit, n_rows)
    try:
        for at in range(max(int(m.params["n_estimators"]) for m in models)):
            growing = {
                (i, k): _Growing(m.params, [m.seed % (1 << 32), at, k])
                for i, m in enumerate(models)
                for k in range(m.outputs)
                if at < int(m.params["n_estimators"])
            }
            while any(g.open for g in growing.values()):
                scans.histograms(growing, at)
                for g in growing.values():
                    g.deepen()
            for i, m in enumerate(models):
                m.rounds.append([growing[i, k].finish() for k in range(m.outputs)] if (i, 0) in growing else [])
            drawn = any(m.params["subsample"] < 1.0 or m.params.get("extra_trees") for m in models)
            if not drawn and not any(t.depth for m in models for t in m.rounds[-1]):
                break  # no split gains anything, now or later
            if at + 1 - scans.since >= ROUNDS_HELD:
                scans.write()
    finally:
        scans.close()
    return models


def held_out(table: DataFrame, models: Sequence[Booster]) -> DataFrame:
    """``model, y, prediction`` for the rows that each model did not learn from."""
    models = list(models)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, y, _, bins, _ in _chunks(source):
            for i, m in enumerate(models):
                rows = np.flatnonzero(~np.isin(g, list(m.train)))
                columns = [np.full(len(rows), i, "i4"), y[rows], m.predicted(bins[rows])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["model", "y", "prediction"])

    return table.mapInArrow(run, "model int, y double, prediction double")


@dataclass(frozen=True)
class LeafBoost:
    """An estimator of one ``Booster``."""

    params: dict
    seed: int = 0

    def fit(
        self, df: DataFrame, xs: Sequence[str], label: Column, n_classes: int, n_rows: int, place: Column
    ) -> Booster:
        cuts = bin_cuts(df.select(*[col(x) for x in xs]), xs, n_rows, BINS) if xs else []
        table = spread_out(binned_rows(df, xs, label, F.lit(0), place, cuts), n_rows)
        path = new_path(df.sparkSession, "binned")
        table.write.parquet(path)
        try:
            table = df.sparkSession.read.schema(table.schema).parquet(path)
            return boost(table, [Booster(dict(self.params), self.seed, cuts, n_classes)])[0]
        finally:
            delete_folder(df.sparkSession, path)
