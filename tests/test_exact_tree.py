"""Exact split points against a search of all distinct values."""

import numpy as np
import pytest

import plumbline as pl
from plumbline.operators import exact_tree as module


def frame(spark, x, y, kind="double"):
    rows = [(*map(float, r), t) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(x.shape[1])) + f", y {kind}")


def deviation(y, classes):
    if classes:
        return len(y) - sum(k * k for k in np.unique(y, return_counts=True)[1]) / max(1, len(y))
    return float(((y - y.mean()) ** 2).sum()) if len(y) else 0.0


def brute(x, y, depth, classes, min_rows=1):
    """Leaves (rows, threshold path) of greedy best splits over all values."""
    best = None
    for i in range(x.shape[1]):
        own = np.unique(x[:, i])
        for a, b in zip(own, own[1:]):
            left = x[:, i] <= a
            if min(left.sum(), (~left).sum()) < min_rows:
                continue
            gain = deviation(y, classes) - deviation(y[left], classes) - deviation(y[~left], classes)
            if best is None or gain > best[0] + 1e-7:
                best = (gain, i, a / 2 + b / 2, left)
    if depth == 0 or best is None or best[0] < 1e-7:
        return [len(y)], []
    _, i, t, left = best
    a, b = (brute(x[k], y[k], depth - 1, classes, min_rows) for k in (left, ~left))
    return a[0] + b[0], [(i, t)] + a[1] + b[1]


def splits(node):
    return [] if node.feature is None else [(int(node.feature[1:]), node.threshold)] + splits(node.left) + splits(node.right)


@pytest.fixture(autouse=True, params=["one scan", "many scans"])
def limits(request, monkeypatch):
    """Few cells and rows, so that cells are cut again and again."""
    if request.param == "many scans":
        monkeypatch.setattr(module, "CELLS", 4)
        monkeypatch.setattr(module, "GATHER_ROWS", 12)
        monkeypatch.setattr(module, "CUT_ROWS", 60)


@pytest.mark.parametrize("classes", [0, 2, 4])
def test_equals_a_search_of_all_values(spark, classes):
    rng = np.random.default_rng(classes)
    x = np.column_stack([rng.normal(size=400), rng.exponential(size=400), rng.integers(0, 5, 400)])
    y = np.where(x[:, 0] > 0.7123, 3, 0) + np.where(x[:, 1] > 0.31, 1, 0) + rng.normal(size=400) / 3
    if classes:
        y = np.clip(np.floor(y), 0, classes - 1).astype(int)
    spec = pl.TableSpec("y", "categorical" if classes else "numerical")
    df = frame(spark, x, y.tolist(), "int" if classes else "double")
    tree = pl.exact_tree(df, spec, max_depth=2, min_rows=3)
    leaves, cuts = brute(x, y, 2, bool(classes), 3)
    assert np.array(splits(tree.root)) == pytest.approx(np.array(cuts))
    assert [r["n"] for r in tree.rules().collect()] == leaves
    assert sum(r["importance"] for r in tree.importance().collect()) == pytest.approx(1)


def test_frequent_values_ties_and_constant_targets(spark):
    x = np.array([[0.0, 0.0]] * 50 + [[0.0, 1.0]] * 30 + [[2.0, 2.0]] * 20)
    df = frame(spark, x, [0.0] * 50 + [5.0] * 30 + [9.0] * 20)
    tree = pl.exact_tree(df, pl.TableSpec("y", "numerical"), max_depth=3)
    assert splits(tree.root) == brute(x, np.array([0.0] * 50 + [5.0] * 30 + [9.0] * 20), 3, False)[1]
    flat = pl.exact_tree(frame(spark, x, [4.0] * 100), pl.TableSpec("y", "numerical"))
    assert [(r["rule"], r["n"]) for r in flat.rules().collect()] == [("all rows", 100)]
    with pytest.raises(ValueError, match="missing"):
        pl.exact_tree(df.withColumn("c0", df.c0 * float("nan")), pl.TableSpec("y", "numerical"))
    with pytest.raises(ValueError, match="no rows"):
        pl.exact_tree(df.limit(0), pl.TableSpec("y", "numerical"))
