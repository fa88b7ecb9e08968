"""Equal rows counted once, and trees grown on the counts.

A tree asks for sums over rows. Rows that are equal in all that a model sees, or that lie in
the same bins of all predictors, add to the same sums, so their number stands for them. If a
table has few such cells, whatever its rows, they are gathered once and trees need no further scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from .binned import bin_cuts
from .boosting import BINS, Booster, GridModel, Tree, _bins, _gradients, _Growing, unit_of
from .metrics import METRICS, Metric

#: Cells that are gathered in one place; tables with more are scanned.
MAX_CELLS = 1 << 20
#: Bins of the forests and of the boosted trees of a fixed depth.
DEPTH_BINS = 32


@dataclass
class Cells:
    """``n`` rows each: their group, bins and target.

    ``y`` is the target's value, the class number, or the mean; ``q`` sums the squares of
    what the rows of a cell are away from it.
    """

    group: np.ndarray
    bins: np.ndarray
    y: np.ndarray
    n: np.ndarray
    q: np.ndarray
    cuts: list[np.ndarray]

    def of(self, rows: np.ndarray) -> Cells:
        return replace(self, group=self.group[rows], bins=self.bins[rows], y=self.y[rows], n=self.n[rows], q=self.q[rows])


# ---- counting --------------------------------------------------------------------


def counted(rows: DataFrame, most: int | None = None) -> DataFrame | None:
    """Distinct rows and their number ``_n``, or None where about more than ``most`` differ."""
    most = MAX_CELLS if most is None else most
    about = rows.agg(F.approx_count_distinct(F.xxhash64(*[F.col(c) for c in rows.columns]), 0.02)).first()[0]
    if about > most:
        return None
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))


def viewed(df: DataFrame, xs: Sequence[str], label: Column, group: Column | None = None) -> DataFrame:
    """``g, y, x0, x1, ...``: all that a model sees of a row."""
    group = F.lit(0) if group is None else group
    return df.select(
        group.cast("int").alias("g"), label.cast("double").alias("y"), *[number(x).alias(f"x{i}") for i, x in enumerate(xs)]
    )


def equal_rows(rows: DataFrame) -> pa.Table | None:
    """The distinct rows of ``viewed`` and their number ``_n``, in their order."""
    found = counted(rows)
    if found is None:
        return None
    table = found.limit(MAX_CELLS + 1).toArrow()
    if table.num_rows > MAX_CELLS:
        return None
    for name in table.column_names:
        if table[name].null_count:
            raise ValueError(f"missing values in the {'target' if name == 'y' else 'predictors'} of trees")
    return table.sort_by([(c, "ascending") for c in rows.columns]).combine_chunks()


def cells_of(table: pa.Table, bins: int, cuts: list[np.ndarray] | None = None) -> Cells:
    """Cells of distinct rows, cut at quantiles of all the rows that they stand for if no cuts are given."""
    names = [c for c in table.column_names if c not in ("g", "y", "_n")]
    n = table["_n"].to_numpy().astype("f8")
    columns = [table[c].to_numpy() + 0.0 for c in names]
    cuts = [_cuts(c, n, bins) for c in columns] if cuts is None else cuts
    at = _bins(columns, cuts) if columns else np.empty((len(n), 0), "i2")
    y = table["y"].to_numpy() + 0.0
    return merged(Cells(table["g"].to_numpy(), at, y, n, np.zeros(len(n)), cuts))


def _cuts(values: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """As ``bin_cuts`` has them, of values that come ``n`` times each."""
    own, at = np.unique(values, return_inverse=True)
    if len(own) > bins:
        ends = np.cumsum(np.bincount(at, n))
        ranks = np.maximum(np.ceil(ends[-1] * (np.arange(1, bins + 1) / bins) - 1), 0)
        own = np.unique(own[np.searchsorted(ends, ranks, "right")])
    return own[:-1]


def merged(cells: Cells) -> Cells:
    """One cell for those that are alike in group, bins and target."""
    if not len(cells.n):
        return cells
    keys = [cells.y, *cells.bins.T[::-1], cells.group]
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.flatnonzero(np.r_[True, new[1:]])
    out = cells.of(order[first])
    out.n, out.q = np.add.reduceat(cells.n[order], first), np.add.reduceat(cells.q[order], first)
    return out


def ungrouped(cells: Cells) -> Cells:
    return merged(replace(cells, group=np.zeros_like(cells.group)))


def binned_cells(rows: DataFrame, cuts: list[np.ndarray], n_classes: int) -> Cells | None:
    """Cells of equal bins, and of equal class; of a number, those have the mean target.

    For tables whose rows differ. The sums are of whole numbers, so no order changes them.
    """
    sizes = [len(c) + 1 for c in cuts]
    if math.prod(sizes) * max(1, n_classes) >= 1 << 62:
        return None
    middle, unit = 0.0, 1.0
    if not n_classes:
        n_rows, middle, low, high = rows.agg(F.count("y"), F.avg("y"), F.min("y"), F.max("y")).first()
        middle = float(f"{middle or 0.0:.11e}")
        unit = unit_of(max(abs(v - middle) for v in (low or 0.0, high or 0.0)) or 1.0, n_rows)
    most = MAX_CELLS

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0)]
        waiting, size = [], 0

        def added() -> None:
            parts = [np.concatenate(p) for p in zip(held, *waiting)]
            code, at = np.unique(parts[0], return_inverse=True)
            whole = [np.zeros(len(code), "i8"), np.zeros(len(code), "i8"), np.zeros(len(code))]
            for total, part in zip(whole, parts[1:]):
                np.add.at(total, at, part)
            held[:] = [code, *whole]
            waiting.clear()

        many = False
        for batch in source:
            if many or not batch.num_rows:
                continue
            if batch.column(1).null_count:
                raise ValueError("missing values in the target of trees")
            own = _bins([c.to_numpy(zero_copy_only=False).astype("f8") for c in batch.columns[2:]], cuts)
            y = batch.column(1).to_numpy()
            code = y.astype("i8") if n_classes else np.zeros(len(y), "i8")
            for i, s in enumerate(sizes):
                code = code * s + own[:, i]
            away = np.zeros(len(y)) if n_classes else np.rint((y - middle) / unit)
            waiting.append((code, np.ones(len(y), "i8"), away.astype("i8"), away**2))
            size += len(y)
            if size > most:
                added()
                size, many = 0, len(held[0]) > most
        if waiting:
            added()
        if many or len(held[0]) > most:
            held[:] = [np.full(1, -1), np.ones(1, "i8"), np.zeros(1, "i8"), np.zeros(1)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["code", "n", "s", "q"])

    sums = [F.sum(c).alias(c) for c in ("n", "s", "q")]
    found = rows.mapInArrow(run, "code long, n long, s long, q double").groupBy("code").agg(*sums).limit(most + 1).toArrow()
    found = found.sort_by("code")
    code, n, s, q = (found[c].to_numpy() for c in ("code", "n", "s", "q"))
    if len(code) > most or (len(code) and code[0] < 0):
        return None
    bins = np.empty((len(code), len(sizes)), "i2")
    for i, size in reversed([*enumerate(sizes)]):
        code, bins[:, i] = code // size, code % size
    if n_classes:
        return Cells(np.zeros(len(n), "i4"), bins, code.astype("f8"), n.astype("f8"), np.zeros(len(n)), cuts)
    spare = np.maximum(q - s.astype("f8") ** 2 / n, 0.0) * unit**2
    return Cells(np.zeros(len(n), "i4"), bins, middle + s * unit / n, n.astype("f8"), spare, cuts)


def gathered(rows: DataFrame, n_rows: int, bins: int, n_classes: int, single: bool) -> Cells | None:
    """Cells of the whole table, or None where they are too many.

    ``single``: rows of a cell are drawn one by one, so their targets must be equal.
    """
    table = equal_rows(rows)
    if table is not None:
        return cells_of(table, bins)
    names = [c for c in rows.columns if c not in ("g", "y")]
    if not names or (single and not n_classes):
        return None
    return binned_cells(rows, bin_cuts(rows.select(*names), names, n_rows, bins), n_classes)


# ---- boosting --------------------------------------------------------------------


class DepthBooster(Booster):
    """Trees of a fixed depth on pseudo-residuals, the first on the target.

    Of more than two classes each is told from the rest; the highest margin wins.
    """

    def learning(self, at: int) -> dict:
        depth = int(self.params["max_depth"])
        return {
            **self.params, "num_leaves": 2**depth if depth else 1, "reg_alpha": 0.0, "reg_lambda": 0.0,
            "extra_trees": False, "learning_rate": self.params["learning_rate"] if at else 1.0,
        }

    def slopes(self, y: np.ndarray, margin: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        if self.n_classes:
            own = np.arange(self.n_classes) if self.n_classes > 2 else np.ones(1)
            side = np.where(y[:, None] == own, 1.0, -1.0)
            slope = 4.0 * side / (1.0 + np.exp(np.minimum(2.0 * side * margin, 700.0)))
        else:
            side = y[:, None]
            slope = 2.0 * (side - margin)
        return -(slope if at else side), np.ones_like(margin)

    def begin(self, y: np.ndarray, n: np.ndarray) -> None:
        self.start = np.zeros(self.outputs)


class _LeafSteps:
    """How ``boost`` sees a ``Booster``: its parameters, derivatives and first margins."""

    def __init__(self, model: Booster):
        self.model = model

    def learning(self, at: int) -> dict:
        return self.model.params

    def slopes(self, y: np.ndarray, margin: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        return _gradients(y, margin, self.model.n_classes)

    def begin(self, y: np.ndarray, n: np.ndarray) -> None:
        model = self.model
        if model.n_classes:
            model.begin_classes(np.bincount(y.astype(int), n, model.n_classes) + 1e-9)
        else:
            model.start = np.array([float(f"{math.fsum(y * n) / n.sum():.11e}") if len(n) else 0.0])


def boost_cells(cells: Cells, model: Booster) -> Booster:
    """Train the model on the cells of its groups, as ``boost`` does on rows."""
    if model.train is not None:
        cells = cells.of(np.flatnonzero(np.isin(cells.group, list(model.train))))
    steps = model if isinstance(model, DepthBooster) else _LeafSteps(model)
    steps.begin(cells.y, cells.n)
    if not len(cells.n) or not cells.bins.shape[1] and not isinstance(model, DepthBooster):
        return model
    share = float(model.params["subsample"])
    spread = 1.0 if model.n_classes else float(np.abs(cells.y - (0.0 if isinstance(model, DepthBooster) else model.start[0])).max()) or 1.0
    unit = unit_of(spread, int(cells.n.sum()))
    margin = np.tile(model.start, (len(cells.n), 1))
    for at in range(int(model.params["n_estimators"])):
        n = cells.n
        if share < 1.0:
            n = np.random.default_rng([model.seed % (1 << 32), at]).binomial(n.astype("i8"), share).astype("f8")
        first, second = steps.slopes(cells.y, margin, at)
        first = np.rint(first / unit) * unit
        if model.n_classes:
            second = np.rint(second / unit) * unit
        trees = []
        for k in range(model.outputs):
            growing = _Growing(steps.learning(at), [model.seed % (1 << 32), at, k])
            _grow(growing, cells.bins, np.stack([first[:, k] * n, second[:, k] * n, n]), n > 0)
            trees.append(growing.finish())
        for k, tree in enumerate(trees):
            margin[:, k] += tree.values(cells.bins)
        model.rounds.append(trees)
        drawn = share < 1.0 or model.params.get("extra_trees")
        if not drawn and not isinstance(model, DepthBooster) and not any(t.depth for t in trees):
            break
    return model


def _grow(growing: _Growing, bins: np.ndarray, weights: np.ndarray, kept: np.ndarray) -> None:
    rows = np.flatnonzero(kept)
    bins, weights = bins[rows], weights[:, rows]
    n_bins = int(bins.max(initial=0)) + 1
    node = np.zeros(len(rows), "i8")
    if not bins.shape[1]:
        growing.sums[0], growing.open = weights.sum(1), []
    while growing.open:
        tree = growing.tree
        local = np.full(len(tree.feature), -1)
        local[growing.open] = np.arange(len(growing.open))
        at = local[node]
        chosen = np.flatnonzero(at >= 0)
        shape = (len(growing.open), n_bins)
        hist = np.empty((3, bins.shape[1], *shape))
        for f in range(bins.shape[1]):
            cell = at[chosen] * n_bins + bins[chosen, f]
            for i in range(3):
                hist[i, f] = np.bincount(cell, weights[i, chosen], shape[0] * n_bins).reshape(shape)
        for i, open_node in enumerate(growing.open):
            growing.count(open_node, hist[:, :, i])
        growing.deepen()
        node = _down(tree, node, bins)


def _down(tree: Tree, node: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Each row's node one level deeper, where its node was split."""
    feature, cut, left, right = (np.asarray(v)[node] for v in (tree.feature, tree.cut, tree.left, tree.right))
    low = bins[np.arange(len(node)), np.maximum(feature, 0)] <= cut
    return np.where(feature >= 0, np.where(low, left, right), node)


# ---- forests ---------------------------------------------------------------------


@dataclass
class CellForest(GridModel):
    """Trees over bins; ``values`` has a leaf's class shares or its mean, a row per node."""

    cuts: list[np.ndarray]
    n_classes: int
    trees: list[Tree]
    values: list[np.ndarray]

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        total = sum(v[t.leaf_of(bins)] for t, v in zip(self.trees, self.values))
        return total.argmax(1).astype("f8") if self.n_classes else total[:, 0] / len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Each column's share of a tree's gain, averaged over the trees."""
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            own = np.zeros(len(self.cuts))
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    own[f] += gain
            total += own / own.sum() if own.sum() else own
        return DenseVector(total / total.sum() if total.sum() else total)


def grow_forest(cells: Cells, n_trees: int, max_depth: int, n_classes: int, seed: int, spark=None) -> CellForest:
    """Trees on rows drawn with replacement: a cell of n rows is drawn Poisson(n) times.

    A node tries the root of the number of columns, or a third of it for a number; a
    single tree has all rows and tries all columns. With a session, tasks share the trees.
    """
    d = cells.bins.shape[1]
    tried = d if n_trees == 1 else max(1, math.ceil(math.sqrt(d) if n_classes else d / 3))

    def grow(own: Cells, t: int) -> tuple[Tree, np.ndarray]:
        return _grow_tree(own, n_trees > 1, max_depth, n_classes, tried, np.random.default_rng([seed % (1 << 32), t]))

    if spark is None or n_trees == 1 or len(cells.n) * n_trees < 1 << 20:
        found = [grow(cells, t) for t in range(n_trees)]
    else:
        held = spark.sparkContext.broadcast(cells)
        tasks = min(n_trees, 2 * spark.sparkContext.defaultParallelism)
        found = spark.sparkContext.parallelize(range(n_trees), tasks).map(lambda t: grow(held.value, t)).collect()
        held.destroy()
    return CellForest(cells.cuts, n_classes, [t for t, _ in found], [v for _, v in found])


def _grow_tree(
    cells: Cells, drawn: bool, max_depth: int, n_classes: int, tried: int, rng: np.random.Generator
) -> tuple[Tree, np.ndarray]:
    n = cells.n
    while drawn and len(n):
        n = rng.poisson(cells.n).astype("f8")
        if n.any():
            break
    rows = np.flatnonzero(n > 0)
    n, bins, y = n[rows], cells.bins[rows], cells.y[rows]
    width, n_bins = bins.shape[1], int(bins.max(initial=0)) + 1
    # Sums per node: of each class, or of the rows and their targets.
    kind = y.astype("i8") if n_classes else np.zeros(len(y), "i8")
    parts = n_classes or 1
    centre = 0.0 if n_classes or not len(n) else float((n * y).sum() / n.sum())
    weight = n if n_classes else n * (y - centre)
    tree, node = Tree(), np.zeros(len(n), "i8")
    tree.add()
    sums = [np.bincount(kind, weight, parts)]
    sizes = [n.sum()]
    opened = [0] if width else []
    for level in range(max_depth):
        if not opened:
            break
        local = np.full(len(tree.feature), -1)
        local[opened] = np.arange(len(opened))
        at = local[node]
        chosen = np.flatnonzero(at >= 0)
        mine = np.array([np.isin(np.arange(width), rng.permutation(width)[:tried]) for _ in opened])
        best = np.full(len(opened), -1.0)
        picks: list[tuple | None] = [None] * len(opened)
        for f in range(width):
            users = np.flatnonzero(mine[:, f])
            if not len(users):
                continue
            cell = (at[chosen] * n_bins + bins[chosen, f]) * parts + kind[chosen]
            shape = (len(opened), n_bins, parts)
            left = np.cumsum(np.bincount(cell, weight[chosen], math.prod(shape)).reshape(shape), axis=1)
            if n_classes:
                low = left.sum(2)
            else:
                low = np.cumsum(np.bincount(at[chosen] * n_bins + bins[chosen, f], n[chosen], shape[0] * n_bins).reshape(shape[:2]), axis=1)
            right, high = left[:, -1:] - left, low[:, -1:] - low
            inside = (low > 0) & (high > 0)
            both = _squares(left, low) + _squares(right, high)
            gain = np.where(inside, both - _squares(left[:, -1:], low[:, -1:]), -1.0)
            cut = gain.argmax(1)
            for i in users:
                g = gain[i, cut[i]]
                if g > best[i] and g > 1e-10 * both[i, cut[i]]:
                    best[i], picks[i] = g, (f, int(cut[i]), left[i, cut[i]], low[i, cut[i]])
        now, opened = opened, []
        for own, pick, g in zip(now, picks, best):
            if pick is None:
                continue
            f, cut, left_sums, left_n = pick
            tree.feature[own], tree.cut[own], tree.gain[own] = f, cut, float(g)
            for side, part, size in (("left", left_sums, left_n), ("right", sums[own] - left_sums, sizes[own] - left_n)):
                child = tree.add()
                getattr(tree, side)[own] = child
                sums.append(part)
                sizes.append(size)
                opened.append(child)
            tree.depth = level + 1
        node = _down(tree, node, bins)
    return tree, np.array(sums) / np.maximum(np.array(sizes), 1e-300)[:, None] + centre


def _squares(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (sums**2).sum(2) / np.maximum(n, 1.0)


# ---- estimators ------------------------------------------------------------------


@dataclass(frozen=True)
class CellTrees:
    """A forest (``forest``), one tree (``tree``) or boosted trees of a fixed depth (``boost``).

    ``spark`` builds the Spark ML estimator for tables of too many cells.
    """

    kind: str
    params: dict
    seed: int
    spark: object

    @property
    def single(self) -> bool:
        return self.kind == "forest" or self.kind == "boost" and float(self.params["subsample"]) < 1.0

    def grow(self, cells: Cells, n_classes: int, session=None) -> GridModel:
        depth = int(self.params["max_depth"])
        if self.kind == "boost":
            return boost_cells(cells, DepthBooster(dict(self.params), self.seed, cells.cuts, n_classes))
        trees = int(self.params["n_estimators"]) if self.kind == "forest" else 1
        return grow_forest(cells, trees, depth, n_classes, self.seed, session)


# ---- scores ----------------------------------------------------------------------


def can_score(metric: Metric) -> bool:
    return METRICS.get(metric.name) is metric


def score_cells(cells: Cells, said: np.ndarray, metric: Metric) -> float | None:
    """The metric over the rows of the cells, each with its cell's prediction."""
    if not len(cells.n):
        return None
    n = cells.n.sum()
    if metric.name == "accuracy":
        return float(cells.n[said == cells.y].sum() / n)
    if metric.name == "matthews":
        size = int(max(cells.y.max(), said.max())) + 1
        table = np.bincount((cells.y * size + said).astype("i8"), cells.n, size * size).reshape(size, size)
        t, p = table.sum(1), table.sum(0)
        spread = (n * n - (p**2).sum()) * (n * n - (t**2).sum())
        return float((np.trace(table) * n - (t * p).sum()) / math.sqrt(spread)) if spread > 0 else 0.0
    error = (cells.n * (cells.y - said) ** 2 + cells.q).sum()
    if metric.name == "mse":
        return float(error / n)
    middle = (cells.n * cells.y).sum() / n
    whole = (cells.n * (cells.y - middle) ** 2 + cells.q).sum()
    return float(1 - error / whole) if whole else None
