import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators.models import FourierFeatures

PARAMS = {"gamma": 0.8, "C": 5.0, "epsilon": 0.3, "size": 24}


def wave(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-2, 2, (n, 2))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] + 0.5 * rng.normal(size=n)
    y[:10] += 40  # the loss is linear: far rows pull no harder
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, u double, v double, y double").repartition(parts)


def said(model, x):
    w, b, scale = FourierFeatures(model.params["gamma"], model.params["size"], 0).weights(2)
    return scale * np.cos(x @ w.T + b) @ model.model.weights + model.model.intercept


def objective(weights, intercept, z, y, p):
    return weights @ weights / 2 + p["C"] * np.maximum(np.abs(z @ weights + intercept - y) - p["epsilon"], 0).sum()


def test_no_step_lowers_the_objective(spark):
    x, y = wave(spark)
    model = pl.fit_model(frame(spark, x, y), ["u", "v"], "y", "svr", PARAMS)
    w, b, scale = FourierFeatures(0.8, 24, 0).weights(2)
    z = scale * np.cos(x @ w.T + b)
    found = objective(model.model.weights, model.model.intercept, z, y, PARAMS)
    # A plain subgradient descent, with averaging, from there and from nothing.
    rng = np.random.default_rng(1)
    for start in (np.append(model.model.weights, model.model.intercept), np.zeros(25)):
        at, best = start.copy(), found
        for step in range(4000):
            gap = z @ at[:-1] + at[-1] - y
            side = np.where(np.abs(gap) > 0.3, np.sign(gap), 0.0) * 5.0
            slope = np.append(at[:-1] + z.T @ side, side.sum())
            at = at - slope * 0.5 / (np.linalg.norm(slope) + 1e-12) / (1 + step) ** 0.6
            best = min(best, objective(at[:-1], at[-1], z, y, PARAMS))
        assert found <= best * (1 + 2e-3)
    for _ in range(200):
        moved = rng.normal(size=25) * 10.0 ** rng.uniform(-4, 0)
        assert objective(model.model.weights + moved[:-1], model.model.intercept + moved[-1], z, y, PARAMS) > found * (1 - 1e-3)


def test_rows_inside_the_band_do_not_move_the_fit(spark):
    x, y = wave(spark)
    model = pl.fit_model(frame(spark, x, y), ["u", "v"], "y", "svr", PARAMS)
    first = said(model, x)
    inside = np.abs(first - y) < 0.28
    assert 100 < inside.sum() < 390
    moved = np.where(inside, first + (y - first) * 0.5, y)
    again = said(pl.fit_model(frame(spark, x, moved), ["u", "v"], "y", "svr", PARAMS), x)
    assert again == pytest.approx(first, abs=0.05)
    assert np.abs(again - first).mean() < 0.01


def test_prediction_is_the_weighted_sum_on_any_layout(spark):
    x, y = wave(spark)
    model = pl.fit_model(frame(spark, x, y, 1), ["u", "v"], "y", "svr", PARAMS)
    got = [r[0] for r in model.predict(frame(spark, x, y, 5)).orderBy("id").select("prediction").collect()]
    assert got == pytest.approx(said(model, x))
    other = pl.fit_model(frame(spark, x, y, 7), ["u", "v"], "y", "svr", PARAMS)
    assert said(other, x) == pytest.approx(said(model, x), abs=0.02)


def test_wide_band_and_constant_target_give_a_constant(spark):
    x, y = wave(spark, 50)
    model = pl.fit_model(frame(spark, x, y), ["u", "v"], "y", "svr", {**PARAMS, "epsilon": 100.0})
    assert model.model.weights == pytest.approx(np.zeros(24))
    flat = pl.fit_model(frame(spark, x, np.full(50, 3.0)), ["u", "v"], "y", "svr", PARAMS)
    assert flat.model.intercept == 3.0
    gap = frame(spark, x, y).withColumn("u", F.when(F.col("id") > 3, F.col("u")))
    with pytest.raises(Exception, match="missing values"):
        pl.fit_model(gap, ["u", "v"], "y", "svr", PARAMS)
