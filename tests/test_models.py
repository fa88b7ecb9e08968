import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import gram
from plumbline.operators.models import FourierFeatures
from plumbline.operators.splits import bucket, dealt_folds


def numbers(spark, n=400, d=3, seed=0, noise=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + 5
    y = x @ np.arange(1, d + 1) + noise * rng.normal(size=n) + 2
    names = [f"x{i}" for i in range(d)]
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    schema = ", ".join(["id int", *[f"{c} double" for c in names], "y double"])
    return spark.createDataFrame(rows, schema).repartition(4), x, y, names


def brute_ridge(x, y, alpha):
    xm, ym = x.mean(0), y.mean()
    b = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(x.shape[1]), (x - xm).T @ (y - ym))
    return ym - xm @ b, b


@pytest.mark.parametrize("d", [3, 14])
def test_ridge_closed_form_both_ways(spark, d):
    df, x, y, names = numbers(spark, d=d)
    model = pl.Ridge(7.0).fit(df, names, "y")
    intercept, b = brute_ridge(x, y, 7.0)
    assert model.intercept == pytest.approx(intercept)
    assert [model.coef[c] for c in names] == pytest.approx(b.tolist())


def test_matrix_sums_equal_native_sums(spark):
    df, x, y, names = numbers(spark)
    native = gram.group_moments(df, names, "y", F.col("id") % 3)
    rows = df.select((F.col("id") % 3).alias("g"), F.lit(1.0).alias("z0"), *names)
    a = {r["g"]: r["sums"] for r in gram._native_sums(rows).collect()}
    b = {r["g"]: r["sums"] for r in gram._matrix_sums(rows).collect()}
    assert set(a) == {0, 1, 2}
    for g in a:
        assert a[g] == pytest.approx(b[g])
    assert native.n_rows == 400


def test_missing_values_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "x double, y double")
    with pytest.raises(ValueError, match="missing"):
        pl.Ridge().fit(df, ["x"], "y")


def test_tuned_ridge_equals_brute_force_cross_validation(spark):
    df, x, y, names = numbers(spark, noise=3.0)
    spec = pl.TableSpec("y", "numerical", key=("id",))
    trials = [{"alpha": a} for a in (0.1, 10.0, 1000.0)]
    tuned = pl.tune(df, spec, "ridge", trials=trials, folds=3, repeats=2, scaling=True, seed=4)
    buckets = np.array([r[0] for r in df.select("id", bucket(df, ["id"], 4).alias("b")).orderBy("id").select("b").collect()])
    want = []
    for t in trials:
        scores = []
        for rep in range(2):
            dealt = np.array(dealt_folds(3, rep, 4))[buckets]
            for f in range(3):
                train, test = dealt != f, dealt == f
                mean, sd = x[train].mean(0), x[train].std(0)
                a, b = brute_ridge((x[train] - mean) / sd, y[train], t["alpha"])
                scores.append((((x[test] - mean) / sd @ b + a - y[test]) ** 2).mean())
        want.append(np.mean(scores))
    got = {r["trial"]: r["score"] for r in tuned.trial_scores().collect()}
    assert [got[i] for i in range(3)] == pytest.approx(want)
    assert tuned.best["alpha"] == trials[int(np.argmin(want))]["alpha"]
    assert tuned.score(df).first()["score"] > 0
    assert tuned.trials.count() == 3 * 2 * 3


def test_generic_path_agrees_with_the_sums_path(spark):
    df, x, y, names = numbers(spark, n=300)
    spec = pl.TableSpec("y", "numerical", key=("id",))
    fast = pl.tune(df, spec, "ridge", trials=[{"alpha": 5.0}], folds=3, repeats=1, seed=1)
    mae = pl.Metric("mse_again", False, lambda a, b: F.avg((a - b) ** 2))
    slow = pl.tune(df, spec, "ridge", trials=[{"alpha": 5.0}], folds=3, repeats=1, seed=1, metric=mae)
    one, two = (t.trial_scores().first()["score"] for t in (fast, slow))
    assert one == pytest.approx(two)


def test_tuned_classifier_with_categories(spark):
    rows = [(i, float(i % 10), "abc"[i % 3], "yes" if i % 3 == 0 else "no") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, k string, y string")
    spec = pl.TableSpec("y", "categorical", ("k",), key=("id",))
    tuned = pl.tune(df, spec, "tree_clf", trials=[{"max_depth": 1}, {"max_depth": 3}], metric="matthews",
                    folds=2, repeats=1)
    assert {r["score"] for r in tuned.trial_scores().collect()} == {1.0}
    out = tuned.predict(df)
    assert set(out.columns) >= {"id", "y", "prediction", "dm__x", "oh__k_1"}
    assert out.filter("prediction != y").count() == 0
    unseen = tuned.predict(spark.createDataFrame([(1, 2.0, "new")], "id int, x double, k string"))
    assert unseen.first()["prediction"] in ("yes", "no")


def test_unknown_family(spark):
    with pytest.raises(ValueError):
        pl.fit_model(spark.range(3), ["id"], "id", "boosting")


def test_fourier_features_approximate_the_kernel(spark):
    a, b, gamma = np.array([0.3, -0.2]), np.array([0.1, 0.5]), 0.7
    df = spark.createDataFrame([(0, 0.3, -0.2), (1, 0.1, 0.5)], "id int, x double, z double")
    got = np.array(df.orderBy("id").select(F.array(*FourierFeatures(gamma, 300).columns(["x", "z"])).alias("f")).toPandas()["f"].tolist())
    assert got[0] @ got[1] == pytest.approx(np.exp(-gamma * ((a - b) ** 2).sum()), abs=0.1)


@pytest.mark.parametrize("classes", [2, 3])
def test_kernel_classifier_learns_rings(spark, classes):
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, (500, 2))
    label = np.minimum((x**2).sum(1) // 1.5, classes - 1).astype(int)
    df = spark.createDataFrame([(float(u), float(v), f"c{k}") for (u, v), k in zip(x, label)], "u double, v double, y string")
    model = pl.fit_model(df, ["u", "v"], "y", "svc", {"gamma": 0.7, "C": 100.0, "max_iter": 20})
    assert model.score(df, "accuracy").first()["score"] > 0.9


def test_kernel_regressor_learns_a_wave(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(-2, 2, (500, 1))
    df = spark.createDataFrame([(float(u), float(np.sin(3 * u))) for (u,) in x], "u double, y double")
    model = pl.fit_model(df, ["u"], "y", "svr", {"gamma": 2.0, "C": 100.0, "max_iter": 40})
    assert model.score(df, "r2").first()["score"] > 0.9


@pytest.mark.parametrize("family,params", [("gbt_clf", {"n_estimators": 3}), ("forest_clf", {"n_estimators": 5}), ("tree_clf", {})])
def test_class_labels_come_back(spark, family, params):
    rows = [(float(i), ["low", "mid", "high"][i // 40]) for i in range(120)]
    df = spark.createDataFrame(rows, "x double, y string")
    model = pl.fit_model(df, ["x"], "y", family, params)
    assert model.score(df, "accuracy").first()["score"] > 0.95


def test_models_work_after_an_observed_job(spark):
    """A session that has counted stages cannot be sent to tasks."""
    audit = pl.StageAudit()
    audit.watch(spark.range(3), "read")
    audit.table().collect()
    df = spark.createDataFrame([(float(i), "ab"[i // 10]) for i in range(20)], "x double, y string")
    model = pl.fit_model(df, ["x"], "y", "svc", {"C": 10.0, "max_iter": 5})
    assert model.predict(df).count() == 20


def test_models_do_not_depend_on_the_layout(spark):
    """The same rows in one, two or eight partitions give the same trees and forests."""
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    lines = lines.withColumn("y", 3 * lines.l_quantity + 400 * lines.l_discount)
    spec = pl.TableSpec("y", "numerical", use_cols=("l_quantity", "l_discount", "l_tax"), key=("l_orderkey",))
    seen = []
    for parts in (1, 2, 8):
        df = lines.repartition(parts)
        rules = [tuple(r) for r in pl.tree_rules(df, spec, max_depth=3).collect()]
        forest = pl.fit_model(df, spec.use_cols, "y", "forest_reg", {"n_estimators": 5})
        seen.append(([r[:3] for r in rules], {k: round(v, 9) for k, v in forest.importances.items()}))
    assert seen[0] == seen[1] == seen[2]


def test_dealt_rows_are_all_there(spark):
    from plumbline.operators.models import dealt

    df = spark.range(5_000).selectExpr("if(id < 3500, 0, id) as a", "cast(null as double) as b")
    out = dealt(df, 5_000)
    assert out.count() == 5_000 and out.filter("a = 0").count() == 3500
    assert out.select("_place").distinct().count() == 5_000


def test_hot_rows_are_dealt_by_several_tasks(spark, monkeypatch):
    """Counted rows are few and small; the tasks that write them out follow from the number of rows."""
    from plumbline.operators import models

    monkeypatch.setattr(models, "DEALT_ROWS", 4_000)
    df = spark.range(40_000).selectExpr("id % 2 as a")
    sizes = models.dealt(df, 40_000).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 40_000 and len(sizes) == 11 and max(sizes) < 20_000


def test_ridge_codes_come_from_the_training_fold(spark):
    """With an ordinal column the fast path scores like the path that fits each fold."""
    rows = [(i, f"k{i % 37}", float(i % 11), float((i * 7919) % 101)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, k string, x double, y double")
    spec = pl.TableSpec("y", "numerical", ("k",), key=("id",))
    fast = pl.tune(df, spec, "ridge", trials=[{"alpha": 3.0}], folds=3, repeats=1, seed=2, scaling=True)
    own = pl.Metric("own", False, lambda y, p: F.avg((y - p) * (y - p)))
    slow = pl.tune(df, spec, "ridge", trials=[{"alpha": 3.0}], folds=3, repeats=1, seed=2, scaling=True, metric=own)
    assert fast.trial_scores().first()["score"] == pytest.approx(slow.trial_scores().first()["score"], rel=1e-9)


@pytest.mark.parametrize("threshold,scaling", [(10, False), (2, True), (0, False)])
def test_ridge_folds_from_one_pass_equal_a_pass_per_fold(spark, monkeypatch, threshold, scaling):
    import random

    from plumbline.operators import tuning

    rng = random.Random(2)
    kinds = ["a", "b", "c", "d", None, "rare"]
    rows = [
        (i, rng.random(), float(rng.randint(0, 9)), rng.choices(kinds, [9, 9, 5, 3, 3, 0.1])[0], rng.choice("uv"), rng.random() + (i % 7))
        for i in range(700)
    ]
    df = spark.createDataFrame(rows, "id int, p double, q double, k string, h string, y double")
    spec = pl.TableSpec("y", "numerical", categorical=("k", "h"), key=("id",))
    options = {"n_trials": 3, "folds": 3, "repeats": 2, "threshold": threshold, "scaling": scaling}
    one = pl.tune(df, spec, "ridge", **options).trials.orderBy("trial", "rep", "fold").collect()
    monkeypatch.setattr(tuning, "INDICATORS", 1)
    many = pl.tune(df, spec, "ridge", **options).trials.orderBy("trial", "rep", "fold").collect()
    assert len(one) == 18
    for a, b in zip(one, many):
        assert (a.trial, a.rep, a.fold) == (b.trial, b.rep, b.fold) and a.score == pytest.approx(b.score, rel=1e-9)
