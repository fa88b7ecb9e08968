import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.functions import columns
from plumbline.operators import groups, histograms

NAN = float("nan")


def test_mean_by_drops_missing_keys_and_values(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", NAN), ("b", None), (None, 9.0)], "k string, y double"
    )
    assert {r[0]: r[1] for r in pl.mean_by(df, "k", "y").collect()} == {"a": 1.0, "b": None}
    assert {r[0]: r[1] for r in pl.count_by(df, "k").collect()} == {"a": 2, "b": 1}


PAIRS = [("x1", "h1", 2.0), ("x1", "h2", 4.0), ("x2", "h1", 6.0), ("x2", "h1", 8.0), (None, "h3", 1.0)]


@pytest.mark.parametrize("small", [10_000, 0])
def test_dense_grid_fills_absent_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(columns, "SMALL_ROWS", small)
    monkeypatch.setattr(columns.small_rows, "__defaults__", (small,))
    df = spark.createDataFrame(PAIRS, "x string, h string, y double")
    means = {(r[0], r[1]): r[2] for r in pl.mean_by(df, "x", "y", "h").collect()}
    assert means == {("x1", "h1"): 2, ("x1", "h2"): 4, ("x2", "h1"): 7, ("x2", "h2"): 0}
    counts = {(r[0], r[1]): r[2] for r in pl.count_by(df, "x", "h").collect()}
    assert counts == {("x1", "h1"): 1, ("x1", "h2"): 1, ("x2", "h1"): 2, ("x2", "h2"): 0}


def test_grid_of_many_columns(spark):
    df = spark.createDataFrame([("a", "u", "h1"), ("b", "u", "h2")], "k string, m string, h string")
    found = {(r[0], r[1], r[2]): r[3] for r in groups.counts_by(df, ["k", "m"], "h").collect()}
    assert len(found) == 6 and found["k", "a", "h2"] == 0 and found["m", "u", "h2"] == 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.integers(1, 12))
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = pl.histogram(df, "v", bins, density=False).orderBy("bin").collect()
    n, edges = np.histogram(values, bins=bins)
    assert [r["n"] for r in got] == n.tolist()
    assert [r["left"] for r in got] + [got[-1]["right"]] == pytest.approx(edges.tolist())


def test_histogram_on_exact_edges(spark):
    values = [i / 10 for i in range(11)] * 3
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (NAN,)], "v double")
    got = pl.histogram(df, "v", 10).orderBy("bin").collect()
    n, edges = np.histogram(values, bins=10, density=True)
    assert [r["height"] for r in got] == pytest.approx(n.tolist())
    assert sum(r["n"] for r in got) == len(values)


@pytest.mark.parametrize("small", [10_000, 0])
def test_histogram_groups_have_their_own_edges(spark, monkeypatch, small):
    monkeypatch.setattr(columns.small_rows, "__defaults__", (small,))
    rows = [("a", float(i)) for i in range(20)] + [("b", 100.0)] * 3 + [(None, 5.0), ("c", None)]
    df = spark.createDataFrame(rows, "h string, v double")
    got = pl.histogram(df, "v", 4, hue="h").orderBy("h", "bin").collect()
    a, b = [r for r in got if r["h"] == "a"], [r for r in got if r["h"] == "b"]
    assert len(got) == 8
    assert [r["n"] for r in a] == [5, 5, 5, 5] and a[0]["left"] == 0 and a[-1]["right"] == 19
    assert [r["n"] for r in b] == [0, 0, 3, 0] and (b[0]["left"], b[-1]["right"]) == (99.5, 100.5)


def test_pair_bins_of_wide_table_match_numpy(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(500, 4))
    df = spark.createDataFrame(data.tolist(), "a double, b double, c double, d double")
    found = pl.pairwise_scatter(df, ["a", "b", "c", "d"], bins=5).collect()
    want = np.histogram2d(data[:, 0], data[:, 2], bins=5)[0]
    got = np.zeros((5, 5))
    for r in found:
        if (r["col1"], r["col2"]) == ("a", "c"):
            got[r["bin1"], r["bin2"]] = r["n"]
    assert (got == want).all()
    assert len({(r["col1"], r["col2"]) for r in found}) == 6


def test_correlations_are_pairwise_complete_and_flat_is_null(spark, monkeypatch):
    monkeypatch.setattr(histograms, "PAIRS_PER_PASS", 2)
    rows = [(1.0, 2.0, 5.0), (2.0, NAN, 5.0), (3.0, 1.0, 5.0), (None, 7.0, 5.0), (5.0, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["col1"], r["col2"]): (r["n"], r["corr"]) for r in pl.pairwise_stats(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == (3, pytest.approx(np.corrcoef([1, 3, 5], [2, 1, 9])[0, 1]))
    assert got["a", "c"] == (4, None)


def test_target_correlation_order(spark):
    df = spark.createDataFrame([(1.0, 1.0, -1.0), (2.0, 2.5, -2.0), (3.0, 2.0, -3.0)], "y double, a double, b double")
    got = pl.target_correlation(df, pl.TableSpec("y", "numerical")).collect()
    assert [r["variable"] for r in got] == ["y", "a", "b"]
    assert got[0]["corr"] == pytest.approx(1) and got[2]["corr"] == pytest.approx(-1)


def test_profile_counts_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (4.0, "a")], "x double, k string")
    spec = pl.TableSpec("x", "numerical", ("k",))
    rows = {(r["variable"], r["field"]): r["value"] for r in pl.profile(df, spec).collect()}
    assert rows["x", "n"] == 2 and rows["x", "n_missing"] == 1 and rows["x", "q50"] == 2.5
    assert rows["k", "n_missing"] == 1 and rows["k", "top:a"] == 2


def test_compare_segments_ignores_unknown(spark):
    df = spark.createDataFrame([(1.0, "u"), (3.0, "u"), (7.0, "v"), (9.0, None)], "x double, k string")
    rows = {r["field"]: tuple(r)[2:] for r in pl.compare_segments(df, F.col("k") == "u", ["x"]).collect()}
    assert rows["n"] == (2, 1, 1) and rows["mean"] == (2, 7, -5)


def test_scatter_points_sample_is_seeded(spark):
    df = spark.range(1000).selectExpr("id as x", "id * 2 as y")
    a = pl.scatter_points(df, "x", "y", fraction=0.1, seed=3).collect()
    assert a == pl.scatter_points(df, "x", "y", fraction=0.1, seed=3).collect() and 50 < len(a) < 150
    assert pl.scatter_points(df, "x", "y").count() == 1000


def test_univariate_kinds(spark):
    df = spark.createDataFrame([(i * 1.0, i % 3 * 1.0, "ab"[i % 2]) for i in range(30)], "y double, x double, k string")
    kinds = {r["kind"] for r in pl.univariate_profile(df, pl.TableSpec("y", "numerical", ("k",))).collect()}
    assert kinds == {"scatter", "mean", "hist", "count"}
    kinds = {r["kind"] for r in pl.univariate_profile(df, pl.TableSpec("k", "categorical")).collect()}
    assert kinds == {"hist"}


def test_many_pairs_equal_few_pairs(spark):
    """Matrix products and plain aggregates agree, with gaps, flat columns and an absent group."""
    rng = np.random.default_rng(4)
    rows = [
        (None if i % 50 == 0 else "ab"[i % 2], *[
            None if (i + j) % 7 == 0 else math.nan if (i + j) % 11 == 0 else 5.0 if j == 2 else float(rng.normal()) * 10**j
            for j in range(7)
        ]) for i in range(400)
    ]
    names = [f"c{j}" for j in range(7)]
    df = spark.createDataFrame(rows, "h string, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    for hue in (None, "h"):
        many = {tuple(r)[:-1]: r["corr"] for r in pl.pairwise_stats(df, names, hue).collect()}
        few = {}
        for a in range(7):
            for b in range(a + 1, 7):
                few |= {tuple(r)[:-1]: r["corr"] for r in pl.pairwise_stats(df, [names[a], names[b]], hue).collect()}
        assert many.keys() == few.keys()
        assert all((many[k] is None) == (few[k] is None) for k in few)
        assert all(few[k] is None or many[k] == pytest.approx(few[k], abs=1e-9) for k in few)


@pytest.mark.parametrize("hue", [None, "h", "d"])
def test_pairs_counted_in_blocks_equal_those_counted_by_rows(spark, monkeypatch, hue):
    values = [(float(i % 7), float(i * i % 11), None if i % 5 == 0 else float(i), i % 3, None if i % 4 == 0 else f"h{i % 2}") for i in range(500)]
    df = spark.createDataFrame(values, "a double, b double, c double, d int, h string").repartition(3)
    cols = [c for c in "abcd" if c != hue]

    def cells():
        return sorted((tuple(r) for r in pl.pairwise_scatter(df, cols, hue, bins=5).collect()), key=str)

    by_rows = cells()
    monkeypatch.setattr(histograms, "WIDE_PAIRS", 0)
    assert cells() == by_rows
    monkeypatch.setattr(histograms, "BLOCK_ROWS", 40)
    assert cells() == by_rows and pl.pairwise_scatter(df.limit(0), cols, hue).count() == 0
