"""Trees from shared histograms against plain trees grown one by one."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline import TableSpec
from plumbline.operators.binned import Binned, best_splits, bin_cuts, bin_rows, narrowed
from plumbline.operators.subsets import split_groups, tree_scorer


def grow(x, y, depth, classes):
    """A tree by trying every cut; returns a function of one row."""

    def impurity(v):
        if classes:
            return len(v) - sum(np.sum(v == c) ** 2 for c in np.unique(v)) / len(v)
        return float(((v - v.mean()) ** 2).sum())

    best, at = 1e-9, None
    if depth and len(y):
        for f in range(x.shape[1]):
            own = 1e-9, None
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                gain = impurity(y) - impurity(y[left]) - impurity(y[~left])
                if gain > own[0] * (1 + 1e-12) + 1e-9:
                    own = gain, (f, cut)
            if own[0] > best * (1 + 1e-9):
                best, at = own
    if at is None:
        value = max(sorted(set(y)), key=lambda c: np.sum(y == c)) if classes else y.mean()
        return lambda row: value
    f, cut = at
    left = x[:, f] <= cut
    below, above = grow(x[left], y[left], depth - 1, classes), grow(x[~left], y[~left], depth - 1, classes)
    return lambda row: below(row) if row[f] <= cut else above(row)


def made(spark, seed=3, n=1200):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randint(0, 20), rng.randint(0, 6) / 2, rng.randint(0, 9)
        y = 3.0 * a - 7 * b + rng.random()
        rows.append((i, float(a), float(b), float(c), y, "hi" if y > 30 else "mid" if y > 12 else "low"))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, k string").repartition(3)


@pytest.mark.parametrize("target,kind,split", [("y", "numerical", "folds"), ("k", "categorical", "folds"), ("y", "numerical", "holdouts")])
def test_scores_of_all_masks(spark, target, kind, split):
    df = made(spark, n=1200 if split == "folds" else 90)
    features, classes = ["a", "b", "c"], kind == "categorical"
    spec = TableSpec(target, kind, use_cols=tuple(features), key=("id",))
    masks = [m for m in product((0, 1), repeat=3) if any(m)]
    with tree_scorer(df, spec, features, classes, max_depth=3, split=split) as scorer:
        got = scorer(masks)
    grouped, splits = split_groups(df, spec.key, 0, split)
    rows = grouped.select("a", "b", "c", target, "_group").toPandas()
    for mask in masks[:: 1 if split == "folds" else 3]:
        own = [f for f, keep in zip(features, mask) if keep]
        scores = []
        for train, test in splits:
            a, b = rows[rows["_group"].isin(train)], rows[rows["_group"].isin(test)]
            tree = grow(a[own].to_numpy(), a[target].to_numpy(), 3, classes)
            said, true = np.array([tree(r) for r in b[own].to_numpy()]), b[target].to_numpy()
            if classes:
                scores.append(np.mean(said == true))
            else:
                scores.append(1 - ((said - true) ** 2).sum() / ((true - true.mean()) ** 2).sum())
        assert got[mask] == pytest.approx(np.mean(scores), abs=1e-9), mask


def test_nodes_are_counted_once(spark):
    df = made(spark)
    cuts = bin_cuts(df, ["a", "b"], 1200)
    rows = bin_rows(df, ["a", "b"], cuts, F.col("y"), F.col("id") % 2)
    binned = Binned(rows, 2, 2)
    paths = [(), ((0, 0, 3),), ((0, 0, 3), (1, 2, 64)), ((0, 9, 2),)]
    found = binned.histograms(paths)
    assert binned.scans == 1 and binned.histograms(paths).keys() == found.keys() and binned.scans == 1
    table = df.toPandas()
    inside = table[(table.a <= cuts[0][3]) & (table.b > cuts[1][1])]
    assert found[paths[2]][0, 0].sum() == len(inside) and found[paths[3]].sum() == 0
    assert found[paths[2]][1, 1].sum() == pytest.approx(inside.y.sum())
    assert narrowed(((0, 2, 5),), 0, 4, 9) == ((0, 4, 5),)


def test_only_the_asked_features_are_counted(spark):
    """A later call adds what an earlier one left out, and nothing twice."""
    df = made(spark)
    cuts = bin_cuts(df, ["a", "b"], 1200)
    rows = bin_rows(df, ["a", "b"], cuts, F.col("y"), F.col("id") % 2)
    binned, whole = Binned(rows, 2, 2), Binned(rows, 2, 2)
    paths = [(), ((0, 0, 3),), ((0, 0, 3), (1, 2, 64)), ((1, 2, 64),)]
    full = whole.histograms(paths)
    first = {p: h.copy() for p, h in binned.histograms(paths, {p: {1} for p in paths}).items()}
    assert all((h[:, 0] == 0).all() and np.allclose(h[:, 1], full[p][:, 1]) for p, h in first.items())
    assert all(np.allclose(h, full[p]) for p, h in binned.histograms(paths).items()) and binned.scans == 2
    assert binned.histograms(paths, {p: {0} for p in paths}) and binned.scans == 2


def test_bins_share_columns(spark):
    """Nine features take two columns, and are counted as each alone."""
    df = made(spark)
    df = df.select("*", *[F.col(c).alias(f"{c}{k}") for k in (1, 2) for c in "abc"])
    names, cuts = [f"{c}{k}" for k in ("", 1, 2) for c in "abc"], bin_cuts(df, ["a", "b", "c"], 1200) * 3
    rows = bin_rows(df, names, cuts, F.col("y"), F.col("id") % 2)
    assert rows.columns == ["g", "y", "p0", "p1"]
    found = Binned(rows, 9, 2).histograms([((8, 1, 64),)])[((8, 1, 64),)]
    alone = Binned(bin_rows(df, names[:3], cuts[:3], F.col("y"), F.col("id") % 2), 3, 2).histograms([((2, 1, 64),)])
    assert np.allclose(found, np.tile(alone[((2, 1, 64),)], (1, 3, 1, 1))) and found.any()


def test_splits_of_one_sided_nodes():
    hist = np.zeros((2, 2, 4))
    hist[0, 0, 2], hist[1, 0, 2] = 5, 10  # all rows in one bin
    hist[0, 1, :2], hist[1, 1, :2] = (2, 3), (0, 10)
    gains, ends = best_splits(hist, 0)
    assert gains[0] == -1 and ends[1] == 0 and gains[1] == pytest.approx(100 / 3 - 100 / 5)


def test_cuts_do_not_depend_on_layout(spark, monkeypatch):
    from plumbline.operators import binned

    monkeypatch.setattr(binned, "CUT_ROWS", 300)
    df = made(spark, n=3000)
    one, many = (bin_cuts(d, ["a", "y"], 3000) for d in (df.coalesce(1), df.repartition(7)))
    assert all((a == b).all() for a, b in zip(one, many)) and len(one[1]) <= 63


def test_search_with_trees_over_all_generations(spark):
    spec = TableSpec("y", "numerical", use_cols=("a", "b", "c"), key=("id",))
    rows = pl.subset_search(made(spark), spec, "DTR", max_features=2).collect()
    assert [r.selected for r in rows if r.n <= 2] == [["a", "b"], ["a"]]


def test_cuts_of_a_large_table_come_from_all_rows(spark, monkeypatch):
    from plumbline.operators import binned

    rng = np.random.default_rng(5)
    n = 6000
    x = {
        "few": rng.integers(1, 8, n).astype(float),
        "many": rng.normal(size=n) ** 5,
        "hot": np.where(rng.random(n) < 0.7, 3.0, rng.normal(size=n)),
        "ends": np.where(rng.random(n) < 0.3, -np.inf, np.where(rng.random(n) < 0.3, np.inf, rng.normal(size=n))),
    }
    rows = [tuple(float(v[i]) for v in x.values()) + (None if i % 3 else float(i),) for i in range(n)]
    df = spark.createDataFrame(rows, "few double, many double, hot double, ends double, gaps double").repartition(5)
    x["gaps"] = np.arange(0, n, 3).astype(float)
    whole = [np.unique(v) if k == "few" else np.unique(np.quantile(v, np.arange(1, 64) / 63, method="inverted_cdf")) for k, v in x.items()]
    monkeypatch.setattr(binned, "CUT_ROWS", 300)
    for gather, accuracy in ((20_000, 10_000), (5, 20)):
        monkeypatch.setattr(binned, "GATHER_ROWS", gather)
        monkeypatch.setattr(binned, "SKETCH_ACCURACY", accuracy)
        found = bin_cuts(df, list(x), n, 63)
        assert all(len(a) == len(b) - 1 and (a == b[:-1]).all() for a, b in zip(found, whole))
