import numpy as np
import pytest

import plumbline as pl


def halves(spark, n=1200):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2, n) * 10.0
    x = rng.normal(size=n)
    z = rng.normal(size=n)
    y = np.where(a > 5, 100 + 4 * x, -3 * x) + 0.01 * rng.normal(size=n)
    rows = [(i, float(p), float(q), float(r), float(s)) for i, (p, q, r, s) in enumerate(zip(a, x, z, y))]
    return spark.createDataFrame(rows, "id int, a double, x double, z double, y double")


SPEC = pl.TableSpec("y", "numerical", key=("id",))


def test_ridge_per_leaf_recovers_both_slopes(spark):
    rows = pl.segment_ridge(halves(spark), SPEC, max_depth=1, alpha=0.1).collect()
    assert [r["rule"] for r in rows] == ["a <= 5", "a > 5"]
    assert [r["coef"]["x"] for r in rows] == pytest.approx([-3, 4], abs=0.05)
    assert rows[1]["intercept"] == pytest.approx(100, abs=0.5) and min(r["r2"] for r in rows) > 0.99


def test_segments_are_ranked(spark):
    rows = pl.useful_segments(halves(spark), SPEC, max_depth=2).collect()
    weights = [r["weight"] for r in rows]
    assert weights == sorted(weights, reverse=True) and sum(r["share"] for r in rows) == pytest.approx(1)


def test_clusters_report_original_units(spark):
    df = spark.createDataFrame([(float(i % 2 * 100 + i % 5), 1.0) for i in range(200)], "u double, flat double")
    rows = {(r["cluster"], r["variable"]): r for r in pl.cluster_profile(df, ["u", "flat"], k=2).collect()}
    assert sorted(r["mean"] for (_, v), r in rows.items() if v == "u") == [2, 102]
    assert {r["n"] for r in rows.values()} == {100}


def test_information_finds_a_curve_that_correlation_misses(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, 2000)
    df = spark.createDataFrame(
        [(float(u), float(v), float(u * u)) for u, v in zip(x, rng.uniform(size=2000))], "x double, noise double, y double"
    )
    got = {r["variable"]: r["score"] for r in pl.binned_mi(df, ["x", "noise"], "y").collect()}
    corr = {r["variable"]: r["corr"] for r in pl.target_correlation(df, pl.TableSpec("y", "numerical")).collect()}
    assert got["x"] > 0.6 and got["noise"] < 0.05 and abs(corr["x"]) < 0.1
    same = {r["variable"]: r["score"] for r in pl.binned_mi(df, ["y"], "y").collect()}
    assert same["y"] == pytest.approx(1, abs=0.01)


def test_reduced_list_is_compared_on_the_same_folds(spark):
    df = halves(spark)
    found = {r["name"]: r for r in pl.compare_subsets(df, SPEC, {"all": ["a", "x", "z"], "one": ["a"]}).collect()}
    assert found["all"]["n"] == 3 and found["all"]["score"] >= found["one"]["score"] > 0.9


def test_leaderboard_order(spark):
    rows = pl.leaderboard(halves(spark), SPEC, {"ridge": {}, "tree_reg": {"max_depth": 3}}).collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0]["score"] <= rows[1]["score"]
    assert rows[0]["family"] == "tree_reg"


def slopes(spark, n=1500):
    """Slope +4 or -4 by ``a`` alone: both halves have the same mean."""
    rng = np.random.default_rng(5)
    a, x, z = rng.uniform(size=n), rng.uniform(-1, 1, n), rng.normal(size=n)
    y = np.where(a > 0.37, 4 * x, -4 * x) + 0.05 * rng.normal(size=n)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(a, x, z, y))]
    return spark.createDataFrame(rows, "id int, a double, x double, z double, y double"), (a, x, z, y)


def test_model_tree_finds_slopes_that_means_hide(spark):
    df, (a, *_) = slopes(spark)
    found = pl.ridge_tree(df, SPEC, max_depth=1, alpha=0.1).collect()
    plain = pl.segment_ridge(df, SPEC, max_depth=1, alpha=0.1).collect()
    assert [round(r["coef"]["x"]) for r in found] == [-4, 4] and min(r["r2"] for r in found) > 0.99
    assert max(r["r2"] for r in plain) < 0.6
    assert found[0]["rule"].startswith("a <= 0.3") and abs(found[0]["n"] - (a <= 0.37).sum()) < 40


def test_model_tree_takes_the_best_of_all_cuts(spark):
    df, (a, x, z, y) = slopes(spark, 90)
    found = pl.ridge_tree(df, SPEC, max_depth=1, alpha=2.0, min_rows=9, bins=200).collect()

    def error(rows):
        m = np.column_stack([a, x, z])[rows]
        m, t = m - m.mean(0), y[rows] - y[rows].mean()
        b = np.linalg.solve(m.T @ m + 2.0 * np.eye(3), m.T @ t)
        return ((t - m @ b) ** 2).sum()

    cuts = [(v, t) for v in (a, x, z) for t in np.sort(v)[8:-9]]
    best = min(error(v <= t) + error(v > t) for v, t in cuts)
    mine = sum((1 - r["r2"]) * _deviation(y, a, x, z, r["rule"]) for r in found)
    assert mine == pytest.approx(best, rel=1e-4)


def _deviation(y, a, x, z, rule):
    name, sign, bound = rule.split()
    v = {"a": a, "x": x, "z": z}[name]
    inside = v <= float(bound) + 1e-6 if sign == "<=" else v > float(bound) + 1e-6
    return ((y[inside] - y[inside].mean()) ** 2).sum()


def test_model_tree_stops_without_gain_and_ignores_layout(spark):
    df, _ = slopes(spark, 300)
    line = df.withColumn("y", 3 * df.x - df.z)
    assert [r["rule"] for r in pl.ridge_tree(line, SPEC).collect()] == ["all rows"]
    one, eight = (
        [(r["rule"], r["n"]) for r in pl.ridge_tree(df.repartition(k), SPEC, max_depth=2, min_rows=20).collect()] for k in (1, 8)
    )
    assert one == eight and len(one) >= 2
    with pytest.raises(ValueError, match="missing"):
        pl.ridge_tree(df.withColumn("a", df.a * float("nan")), SPEC)
    only = pl.ridge_tree(df, SPEC, max_depth=1, split_on=["a"], regressors=["x"]).collect()
    assert set(only[0]["coef"]) == {"x"} and len(only) == 2
