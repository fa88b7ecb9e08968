"""Trees whose split points are exact, found by bounds instead of a sort (L1).

Each node's columns are counted in cells. The edges between cells give the best split so
far; a cell whose best possible inner split cannot beat it is done, the others are cut finer
and counted again. Splits are therefore those of a search of all distinct values, and a
level costs a few scans, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, number
from ..spec import TableSpec
from .binned import CHUNK_ROWS, CUT_ROWS, bin_cuts
from .encoding import encode_categories
from .explain import ExplainedTree, Node
from .gram import column_means
from .models import class_labels, label_index
from .quantiles import GATHER_ROWS

#: Cells of each node and column in the first scan, and of each open cell in later ones.
CELLS = 256
#: Gains closer than this share of the target's squared deviation are equal.
EQUAL = 1e-10

#: (column, lower bound, upper bound) of the rows of a node: lower < value <= upper.
Path = tuple[tuple[int, float, float], ...]


@dataclass
class ExactFit:
    """What the rules need to know of a model."""

    xs: list[str]
    classes: list | None
    importances: dict[str, float]


@dataclass
class _Search:
    """The cells of one node and column, from the left, and where cells still hide a split."""

    node: int
    column: int
    path: Path
    edges: np.ndarray  # upper ends of the cells to count; the last cell may be open
    wanted: np.ndarray  # whether the cell ending there is counted
    cells: pd.DataFrame | None = None  # n, lo, hi, y0, y1, s0, s1, ...

    def open_cells(self, best: float, slack: float) -> pd.DataFrame:
        c = self.cells
        return c[(c["lo"] < c["hi"]) & (_bounds(c) > best + slack)]


def exact_tree(
    df: DataFrame,
    spec: TableSpec,
    features: Sequence[str] | None = None,
    max_depth: int = 3,
    min_rows: int = 1,
) -> ExplainedTree:
    """A tree with the best of all splits ``x <= t`` at every node; both sides keep ``min_rows``.

    The best split leaves the least squared deviation from the sides' means, for classes that of
    the indicators of each class (the usual impurity). ``t`` lies halfway between two neighbouring
    values. Gains within a share of 1e-10 of the table's deviation are equal: the earlier
    column, then the smaller value wins. A node that no split improves is a leaf. Missing
    values are an error, as for all models; categories count as ordinal codes.
    """
    coded = encode_categories(df, spec)
    xs = list(features) if features is not None else spec.numerics(df) + spec.categories(df)
    classes = None if spec.numerical_target else class_labels(coded, spec.target)
    label = number(spec.target) if classes is None else label_index(spec.target, classes)
    n_out = 1 if classes is None else len(classes)
    kept = coded.select(label.alias("y"), *[number(x).alias(f"x{i}") for i, x in enumerate(xs)])
    centre = float(column_means(kept, kept.columns)[0]) if classes is None else 0.0
    n_rows = kept.count()
    cuts = bin_cuts(coded, xs, n_rows, CELLS)
    root, paths, gains = Node(1), {1: ()}, dict.fromkeys(xs, 0.0)
    level, slack = [root], None
    for _ in range(max_depth):
        todo = [
            _Search(node.id, i, paths[node.id], np.append(c, np.inf), np.ones(len(c) + 1, bool))
            for node in level
            for i, c in enumerate(cuts)
        ]
        found = _best_splits(kept, todo, classes is not None, n_out, centre, min_rows, slack)
        slack = found["slack"]
        following = []
        for node in level:
            best = found.get(node.id)
            if best is None:
                continue
            gain, i, t = best
            gains[xs[i]] += gain
            node.feature, node.threshold = xs[i], t
            node.left, node.right = Node(2 * node.id), Node(2 * node.id + 1)
            paths[2 * node.id] = (*paths[node.id], (i, -np.inf, t))
            paths[2 * node.id + 1] = (*paths[node.id], (i, t, np.inf))
            following += [node.left, node.right]
        level = following
        if not level:
            break
    for place, node in enumerate(_from_left(root)):
        node.leaf = place
    whole = sum(gains.values()) or 1.0
    fit = ExactFit(xs, classes, {x: g / whole for x, g in gains.items()})
    return ExplainedTree(fit, root, coded, spec)


def _from_left(node: Node) -> list[Node]:
    return [node] if node.feature is None else _from_left(node.left) + _from_left(node.right)


def _best_splits(kept, searches, is_class, n_out, centre, min_rows, slack) -> dict:
    """Per node its best (gain, column, threshold), and the slack under ``"slack"``."""
    _count(kept, searches, is_class, n_out, centre)
    if slack is None:
        slack = EQUAL * _deviation(searches[0].cells, kept, is_class, centre)
    while True:
        best: dict[int, tuple[float, int, float]] = {}
        for s in searches:
            found = _best_edge(s.cells, min_rows, slack)
            if found and (s.node not in best or found[0] > best[s.node][0] + slack):
                best[s.node] = (found[0], s.column, found[1])
        least = {s.node: best[s.node][0] if s.node in best else 0.0 for s in searches}
        unsure = [(s, s.open_cells(least[s.node], slack)) for s in searches]
        unsure = [(s, cells) for s, cells in unsure if len(cells)]
        if not unsure:
            return {**{k: v for k, v in best.items() if v[0] > slack}, "slack": slack}
        _refine(kept, unsure, is_class, n_out, centre)


def _refine(kept, unsure, is_class, n_out, centre) -> None:
    """Cut the open cells of each search finer and count them again."""
    rows = sum(int(cells["n"].sum()) for _, cells in unsure)
    share = min(1.0, CUT_ROWS / rows)
    parts = []
    for s, cells in unsure:
        lo, hi = np.nextafter(cells["lo"].to_numpy(), -np.inf), cells["hi"].to_numpy()
        parts.append(_Search(s.node, s.column, s.path, *_spans(lo, hi)))
    drawn = _values(kept, parts, 1.0 if rows <= GATHER_ROWS else share)
    for at, part in enumerate(parts):
        values = np.sort(drawn.loc[drawn["at"] == at, "v"].to_numpy())
        where = np.searchsorted(part.edges, values, "left")
        edges, wanted = [], []
        for k, (end, use) in enumerate(zip(part.edges, part.wanted)):
            own = np.unique(values[where == k])
            if use and rows > GATHER_ROWS and len(own) > CELLS:
                own = np.unique(np.quantile(values[where == k], np.arange(1, CELLS) / CELLS, method="inverted_cdf"))
            if use and rows > GATHER_ROWS:  # a frequent value gets a cell of its own
                own = np.unique(np.concatenate([own, np.nextafter(own, -np.inf)]))
                own = own[own > part.edges[k - 1]]
            if use:
                own = own[own < end]
                if not len(own):  # no value drawn
                    own = [_middle(np.nextafter(part.edges[k - 1], np.inf), end)]
                edges += [*own]
                wanted += [True] * len(own)
            edges.append(end)
            wanted.append(use)
        part.edges, part.wanted = np.array(edges), np.array(wanted)
    _count(kept, parts, is_class, n_out, centre)
    for (s, cells), part in zip(unsure, parts):
        rest = s.cells.drop(cells.index)[part.cells.columns]
        s.cells = _with_left(pd.concat([rest, part.cells]).sort_values("lo", ignore_index=True))


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell ends of disjoint sorted spans lo < v <= hi, and which of the cells are spans."""
    edges, wanted = [], []
    for a, b in zip(lo, hi):
        if not edges or edges[-1] < a:
            edges.append(a)
            wanted.append(False)
        edges.append(b)
        wanted.append(True)
    return np.array(edges), np.array(wanted)


# ---- sums over cells ------------------------------------------------------------


def _sums(c: pd.DataFrame, prefix: str) -> np.ndarray:
    return c[[x for x in c.columns if x.startswith(prefix)]].to_numpy()


def _with_left(c: pd.DataFrame) -> pd.DataFrame:
    """The cells with the rows (ln) and sums (l0, l1, ...) to their left."""
    c = c[["n", "lo", "hi", "y0", "y1", *[x for x in c.columns if x[0] == "s"]]].copy()
    s = _sums(c, "s")
    c["ln"] = c["n"].cumsum() - c["n"]
    left = np.cumsum(s, 0) - s
    return pd.concat([c, pd.DataFrame(left, columns=[f"l{k}" for k in range(s.shape[1])], index=c.index)], axis=1)


def _worth(n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Sum over the outputs of s squared over n; nothing without rows."""
    return np.where(n[:, None] > 0, s**2 / np.where(n > 0, n, 1)[:, None], 0.0)


def _left_sums(c: pd.DataFrame) -> np.ndarray:
    return c[[x for x in c.columns if x[0] == "l" and x[1:].isdigit()]].to_numpy()


def _best_edge(c: pd.DataFrame, min_rows: int, slack: float) -> tuple[float, float] | None:
    """(gain, threshold) of the best split between two cells."""
    if len(c) < 2:
        return None
    n, s = c["n"].to_numpy(float), _sums(c, "s")
    left_n, left_s = np.cumsum(n)[:-1], np.cumsum(s, 0)[:-1]
    all_n, all_s = n.sum(), s.sum(0)
    gain = (_worth(left_n, left_s) + _worth(all_n - left_n, all_s - left_s)).sum(1)
    gain -= (all_s**2 / all_n).sum()
    gain[(left_n < min_rows) | (all_n - left_n < min_rows)] = -np.inf
    if gain.max() == -np.inf:
        return None
    at = int(np.flatnonzero(gain >= gain.max() - slack)[0])
    low, high = float(c["hi"].iloc[at]), float(c["lo"].iloc[at + 1])
    return float(gain[at]), _middle(low, high)


def _middle(low: float, high: float) -> float:
    """A number from ``low`` to below ``high``, halfway if there is one."""
    middle = low / 2 + high / 2
    return middle if low <= middle < high else low


def _bounds(c: pd.DataFrame) -> np.ndarray:
    """What no split inside a cell can gain more than.

    The k rows of the cell that go left have a sum t between k times its smallest and k times its
    largest target, and so have those that go right. The gain is convex in (k, t), so it is largest
    at a corner of that region. Outputs are bounded one by one.
    """
    n, s, ln, ls = c["n"].to_numpy(float), _sums(c, "s"), c["ln"].to_numpy(float), _left_sums(c)
    all_n, all_s = n.sum(), s.sum(0)
    if s.shape[1] == 1:
        low, high = c["y0"].to_numpy()[:, None], c["y1"].to_numpy()[:, None]
    else:  # indicators
        low, high = (s == n[:, None]).astype(float), (s > 0).astype(float)
    span = np.where(high > low, high - low, 1.0)
    k = np.clip(np.where(high > low, (s - n[:, None] * low) / span, 0.0), 0.0, n[:, None])
    best = np.zeros_like(s)
    for rows, total in (
        (np.zeros_like(s), np.zeros_like(s)),
        (np.broadcast_to(n[:, None], s.shape), s),
        (k, k * high),
        (n[:, None] - k, (n[:, None] - k) * low),
    ):
        left_n, left_s = ln[:, None] + rows, ls + total
        right_n, right_s = all_n - left_n, all_s - left_s
        left = np.where(left_n > 0, left_s**2 / np.where(left_n > 0, left_n, 1), 0.0)
        right = np.where(right_n > 0, right_s**2 / np.where(right_n > 0, right_n, 1), 0.0)
        best = np.maximum(best, left + right)
    return best.sum(1) - (all_s**2 / all_n).sum()


def _deviation(cells: pd.DataFrame, kept: DataFrame, is_class: bool, centre: float) -> float:
    """Squared deviation of the target in the whole table."""
    if is_class:
        n, s = cells["n"].sum(), _sums(cells, "s").sum(0)
        return float(n - (s**2).sum() / n)
    shifted = F.col("y") - F.lit(centre)
    return float(kept.agg(F.sum(shifted * shifted)).first()[0])


# ---- scans ------------------------------------------------------------------------


def _masked(table: pa.Table, searches: Sequence[_Search]) -> Iterator[tuple[int, _Search, np.ndarray, np.ndarray, np.ndarray]]:
    """Per search: the rows of its node in wanted cells, their values and cells."""
    columns: dict[int, np.ndarray] = {}
    inside: dict[int, np.ndarray] = {}

    def column(i: int) -> np.ndarray:
        if i not in columns:
            columns[i] = table.column(f"x{i}").to_numpy()
        return columns[i]

    for at, s in enumerate(searches):
        if s.node not in inside:
            mask = np.ones(table.num_rows, bool)
            for i, low, high in s.path:
                mask &= (column(i) > low) & (column(i) <= high)
            inside[s.node] = np.flatnonzero(mask)
        rows = inside[s.node]
        v = column(s.column)[rows]
        cell = np.searchsorted(s.edges, v, "left")
        use = np.append(s.wanted, False)[cell]
        yield at, s, rows[use], v[use], cell[use]


def _tables(source: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in source:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _count(kept: DataFrame, searches: Sequence[_Search], is_class: bool, n_out: int, centre: float) -> None:
    """Fill in the cells of all searches in one scan, summed per chunk, then over the tasks."""
    names = [f"s{k}" for k in range(n_out)]

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(source):
            y = table.column("y").to_numpy() - centre
            for at, s, rows, v, cell in _masked(table, searches):
                if not len(rows):
                    continue
                own, place, n = np.unique(cell, return_inverse=True, return_counts=True)
                ends = {"lo": np.full(len(own), np.inf), "hi": np.full(len(own), -np.inf)}
                ends |= {"y0": ends["lo"].copy(), "y1": ends["hi"].copy()}
                y_in = y[rows]
                np.minimum.at(ends["lo"], place, v)
                np.maximum.at(ends["hi"], place, v)
                np.minimum.at(ends["y0"], place, y_in)
                np.maximum.at(ends["y1"], place, y_in)
                if is_class:
                    count = np.bincount(place * n_out + y_in.astype("i8"), minlength=len(own) * n_out)
                    sums = count.reshape(-1, n_out).T.astype("f8")
                else:
                    sums = [np.bincount(place, y_in, len(own))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), at, "i4")),
                        pa.array(own.astype("i4")),
                        pa.array(n.astype("i8")),
                        *[pa.array(e) for e in ends.values()],
                        *[pa.array(np.ascontiguousarray(x)) for x in sums],
                    ],
                    names=["at", "cell", "n", *ends, *names],
                )

    schema = "at int, cell int, n long, lo double, hi double, y0 double, y1 double, "
    counted = kept.mapInArrow(scan, schema + ", ".join(f"{x} double" for x in names))
    found = (
        counted.groupBy("at", "cell")
        .agg(
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.min("y0").alias("y0"),
            F.max("y1").alias("y1"),
            *[F.sum(x).alias(x) for x in names],
        )
        .toPandas()
        .sort_values(["at", "cell"])
    )
    groups = dict(iter(found.groupby("at")))
    for at, s in enumerate(searches):
        s.cells = _with_left(groups.get(at, found.iloc[:0]).reset_index(drop=True))


def _values(kept: DataFrame, searches: Sequence[_Search], share: float) -> pd.DataFrame:
    """``at, v``: distinct values in the wanted cells, of all rows or a share chosen by a hash.

    At most about ``CUT_ROWS`` come to the driver; cuts between cells change the cost of the
    search, not its result.
    """
    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(source):
            for at, _, _, v, _ in _masked(table, searches):
                own = np.unique(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), at, "i4")), pa.array(own)], names=["at", "v"])

    rows = kept
    if share < 1.0:
        hashed = F.pmod(F.xxhash64(*[col(c) for c in kept.columns]), F.lit(1 << 40))
        rows = kept.filter(hashed < int(share * (1 << 40)))
    return rows.mapInArrow(scan, "at int, v double").distinct().toPandas()
