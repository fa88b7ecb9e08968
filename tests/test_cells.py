import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import boosting, cells, models

XS = ["a", "b", "c"]


def table(spark, n=3000, seed=0, parts=4):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 6, n), rng.integers(0, 4, n), rng.integers(0, 5, n)
    y = 2.0 * a + 5.0 * (b > 1) * (c > 2)
    rows = [(i, *map(float, r), "xyz"[int(r[3] > 5) + int(r[3] > 10)]) for i, r in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, name string").repartition(parts)


def jobs_of(spark, name, run):
    """Jobs that a call starts: what a scan of the table costs, if the table is large."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("family,y", [("gbt_reg", "y"), ("gbt_clf", "name"), ("leaf_reg", "y"), ("leaf_clf", "name"), ("forest_reg", "y")])
def test_more_trees_cost_no_more_scans(spark, family, y):
    df = table(spark)
    few, many = (jobs_of(spark, f"{family}{k}", lambda: pl.fit_model(df, XS, y, family, {"n_estimators": k, "max_depth": 3})) for k in (2, 12))
    assert few == many


def test_more_trials_cost_no_more_scans(spark):
    df = table(spark)
    spec = pl.TableSpec("name", "categorical", use_cols=tuple(XS), key=("id",))
    one = {"n_estimators": 4, "max_depth": 2}
    seen = [jobs_of(spark, f"t{k}", lambda: pl.tune(df, spec, "gbt_clf", trials=[one] * k, folds=3, repeats=1)) for k in (1, 3)]
    assert seen[0] == seen[1]


@pytest.mark.parametrize("family", ["gbt_reg", "leaf_reg", "forest_reg", "tree_reg"])
def test_cells_learn_what_the_rows_say(spark, family):
    df = table(spark)
    model = pl.fit_model(df, XS, "y", family, {"max_depth": 5})
    assert model.score(df, "r2").first()["score"] > 0.9
    weight = model.importances
    assert sum(weight.values()) == pytest.approx(1.0) and weight["a"] > max(weight["b"], weight["c"])
    assert model.predict(df).count() == df.count()


def test_boosted_trees_equal_those_of_spark_ml(spark, monkeypatch):
    """The same splits, leaves and importances, on rows and on their numbers."""
    df = table(spark)
    p = {"n_estimators": 6, "max_depth": 3, "min_child_samples": 40}
    for family, y in (("gbt_reg", "y"), ("gbt_clf", "two")):
        frame = df.withColumn("two", F.when(F.col("y") > 6, "more").otherwise("less"))
        monkeypatch.setattr(models, "_fit_cells", models_fit)
        own = pl.fit_model(frame, XS, y, family, p)
        monkeypatch.setattr(models, "_fit_cells", lambda *a: None)
        theirs = pl.fit_model(frame, XS, y, family, p)
        assert own.importances == pytest.approx(theirs.importances, abs=1e-6)
        a, b = ([r["prediction"] for r in m.predict(frame).orderBy("id").collect()] for m in (own, theirs))
        assert a == (pytest.approx(b, abs=1e-6) if family == "gbt_reg" else b)


models_fit = models._fit_cells


def test_leaf_trees_of_cells_equal_those_of_scans(spark, monkeypatch):
    df = table(spark)
    p = {"n_estimators": 4, "num_leaves": 6, "min_child_samples": 30}
    for family, y in (("leaf_reg", "y"), ("leaf_clf", "name")):
        own = pl.fit_model(df, XS, y, family, p).model.rounds
        monkeypatch.setattr(models, "_fit_cells", lambda *a: None)
        scanned = pl.fit_model(df, XS, y, family, p).model.rounds
        monkeypatch.setattr(models, "_fit_cells", models_fit)
        assert [[(t.feature, t.cut) for t in r] for r in own] == [[(t.feature, t.cut) for t in r] for r in scanned]
        assert [v for r in own for t in r for v in t.value] == pytest.approx([v for r in scanned for t in r for v in t.value], abs=1e-6)


@pytest.mark.parametrize("family,y", [("leaf_reg", "z"), ("gbt_reg", "z"), ("leaf_clf", "name"), ("gbt_clf", "name")])
def test_bins_of_rows_that_all_differ(spark, monkeypatch, family, y):
    """No two rows are equal, but many lie in the same bins; their sums give the same trees."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 2))
    z = x[:, 0] ** 2 + np.where(x[:, 1] > 0, 3.0, 0.0) + 0.1 * rng.normal(size=2000)
    rows = [(i, float(u), float(v), float(t), "pqr"[int(t > 1) + int(t > 3)]) for i, ((u, v), t) in enumerate(zip(x, z))]
    df = spark.createDataFrame(rows, "id int, u double, v double, z double, name string").repartition(3)
    p = {"n_estimators": 5, "max_depth": 3}
    seen = []
    for most in (1 << 20, 1500):  # all rows as cells, and cells of bins
        monkeypatch.setattr(cells, "MAX_CELLS", most)
        monkeypatch.setattr(models, "BINS", 32)
        model = pl.fit_model(df, ["u", "v"], y, family, p)
        assert isinstance(model.model, boosting.Booster)
        seen.append([r["prediction"] for r in model.predict(df).orderBy("id").collect()])
    assert seen[0] == (seen[1] if y == "name" else pytest.approx(seen[1], abs=1e-6))


def test_forests_draw_rows_and_not_cells(spark):
    """A cell of n rows is drawn Poisson(n) times, so large cells keep nearly all their weight."""
    df = spark.range(40_000).selectExpr("cast(id % 2 as double) as x", "cast(id % 2 as double) as y")
    model = pl.fit_model(df, ["x"], "y", "forest_reg", {"n_estimators": 20})
    assert {round(r["prediction"], 6) for r in model.predict(df).select("prediction").distinct().collect()} == {0.0, 1.0}
    big = cells.Cells(np.zeros(1, "i4"), np.zeros((1, 1), "i2"), np.zeros(1), np.array([1e6]), np.zeros(1), [np.empty(0)])
    assert len(cells.grow_forest(big, 3, 2, 2, 0).trees) == 3


def test_scores_of_cells_equal_those_of_rows(spark):
    df = table(spark)
    spec = pl.TableSpec("name", "categorical", use_cols=tuple(XS), key=("id",))
    for metric in ("matthews", "accuracy"):
        own = pl.tune(df, spec, "tree_clf", trials=[{"max_depth": 2}], metric=metric, folds=3, repeats=1)
        named = pl.Metric("other", True, pl.operators.metrics.METRICS["accuracy"].expr) if metric == "accuracy" else None
        if named:
            slow = pl.tune(df, spec, "tree_clf", trials=[{"max_depth": 2}], metric=named, folds=3, repeats=1)
            assert own.trial_scores().first()["score"] == pytest.approx(slow.trial_scores().first()["score"])
        assert 0.5 < own.trial_scores().first()["score"] <= 1.0


def rings(spark, n=2400):
    rng = np.random.default_rng(8)
    u, v = rng.integers(-6, 7, n) / 3.0, rng.integers(-6, 7, n) / 3.0
    rows = [(float(a), float(b), float(np.sin(2 * a) + b), "pqr"[int(a * a + b * b > 1.5) + int(a * a + b * b > 4)]) for a, b in zip(u, v)]
    return spark.createDataFrame(rows, "u double, v double, y double, k string").repartition(3)


def test_the_band_of_equal_rows_costs_no_scan_a_pass(spark, monkeypatch):
    from plumbline.operators import tube

    df = rings(spark)
    given = {"gamma": 0.5, "C": 5.0, "epsilon": 0.05}
    seen = [jobs_of(spark, f"svr{k}", lambda: pl.fit_model(df, ["u", "v"], "y", "svr", {**given, "max_iter": k})) for k in (3, 12)]
    assert seen[0] == seen[1]
    own = pl.fit_model(df, ["u", "v"], "y", "svr", given).model
    monkeypatch.setattr(tube, "counted", lambda *a: None)
    monkeypatch.setattr(tube, "HERE_ROWS", 0)
    rows = pl.fit_model(df, ["u", "v"], "y", "svr", given).model
    z = np.random.default_rng(0).normal(size=(50, 64)) / 6
    assert z @ own.weights + own.intercept == pytest.approx(z @ rows.weights + rows.intercept, abs=1e-2)


def test_kernel_classes_are_fitted_on_distinct_rows(spark, monkeypatch):
    df, seen = rings(spark), []
    given = {"gamma": 0.7, "C": 20.0, "max_iter": 60}
    fit = models.OneAgainstRest.fit.__func__

    def watched(cls, estimator, train, n_classes):
        seen.append(train.count())
        return fit(cls, estimator, train, n_classes)

    monkeypatch.setattr(models.OneAgainstRest, "fit", classmethod(watched))
    own = pl.fit_model(df, ["u", "v"], "k", "svc", given)
    monkeypatch.setattr(models, "_takes_weights", lambda estimator: False)
    rows = pl.fit_model(df, ["u", "v"], "k", "svc", given)
    assert seen == [df.select("u", "v").distinct().count(), df.count()]
    assert own.score(df, "accuracy").first()["score"] == pytest.approx(rows.score(df, "accuracy").first()["score"], abs=0.02)


@pytest.mark.parametrize("family,y", [("svr", "y"), ("svc", "k")])
def test_kernel_predictions_equal_those_of_the_vectors(spark, monkeypatch, family, y):
    df = rings(spark, 600)
    odd = df.select("u", "v").unionByName(spark.range(40).selectExpr("id / 7.0D as u", "if(id = 3, double('nan'), id / 3.0D) as v")).coalesce(1)
    model = pl.fit_model(df, ["u", "v"], y, family, {"gamma": 0.5, "max_iter": 20})
    own = [r["prediction"] for r in model.predict(odd).collect()]
    monkeypatch.setattr(models, "_linear_parts", lambda m: None)
    theirs = [r["prediction"] for r in model.predict(odd).collect()]
    assert own == (pytest.approx(theirs, nan_ok=True) if family == "svr" else theirs)
    with pytest.raises(Exception):
        model.predict(spark.createDataFrame([(None, 1.0)], "u double, v double")).collect()
