import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl


def one(spark, pairs, metric, schema="y int, p int"):
    return pl.score(spark.createDataFrame(pairs, schema), "y", "p", metric).first()["score"]


def brute_matthews(y, p):
    classes = sorted(set(y) | set(p))
    a = np.array([[v == c for c in classes] for v in y], float)
    b = np.array([[v == c for c in classes] for v in p], float)
    cov = lambda u, v: ((u - u.mean(0)) * (v - v.mean(0))).sum()
    return cov(a, b) / np.sqrt(cov(a, a) * cov(b, b))


def test_matthews_three_classes(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 200)
    p = np.where(rng.random(200) < 0.6, y, rng.integers(0, 4, 200))
    pairs = [(int(a), int(b)) for a, b in zip(y, p)]
    assert one(spark, pairs, "matthews") == pytest.approx(brute_matthews(y, p))
    as_text = [(str(a), str(b)) for a, b in pairs]
    assert one(spark, as_text, "matthews", "y string, p string") == pytest.approx(brute_matthews(y, p))
    mixed = [(a, float(b)) for a, b in pairs]
    assert one(spark, mixed, "matthews", "y int, p double") == pytest.approx(brute_matthews(y, p))


def test_matthews_zero_denominator(spark):
    assert one(spark, [(1, 1), (1, 1)], "matthews") == 0.0


def test_regression_scores(spark):
    pairs = [(1, 2), (3, 3), (5, 4)]
    assert one(spark, pairs, "mse") == pytest.approx(2 / 3)
    assert one(spark, pairs, "r2") == pytest.approx(1 - 2 / 8)
    assert one(spark, [(1, 2), (1, 3)], "r2") is None
    assert one(spark, pairs, "accuracy") == pytest.approx(1 / 3)


def test_groups_and_direction(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 3, 3)], "g string, y int, p int")
    assert {r["g"]: r["score"] for r in pl.score(df, "y", "p", "accuracy", ["g"]).collect()} == {"a": 0.5, "b": 1.0}
    assert not pl.METRICS["mse"].higher_is_better and pl.METRICS["r2"].higher_is_better
    with pytest.raises(ValueError):
        pl.score(df, "y", "p", "auc")


def test_custom_metric(spark):
    worst = pl.Metric("worst", False, lambda y, p: F.max(F.abs(y - p)))
    assert one(spark, [(1, 2), (3, 8)], worst) == 5


def brute_front(points):
    return sorted(
        (a, b) for a, b in points
        if not any(x <= a and y >= b and (x, y) != (a, b) for x, y in points)
    )


@pytest.mark.parametrize("seed", range(3))
def test_front_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    points = [(int(a), float(b)) for a, b in zip(rng.integers(0, 40, 300), rng.integers(0, 60, 300) + rng.integers(0, 3))]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, n int, s double")
    got = sorted((r["n"], r["s"]) for r in pl.pareto_front(df, "n", "s").collect())
    assert got == brute_front(points)


def test_front_where_nothing_is_dominated(spark):
    df = spark.range(500).selectExpr("id as n", "double(id * id) as s")
    assert pl.pareto_front(df, "n", "s").count() == 500


def test_front_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "n int, s double")
    assert pl.pareto_front(df, "n", "s").count() == 0


def brute_front_of(rows, low, high):
    def value(r):
        return tuple(r[i] for i in low) + tuple(-r[i] for i in high)

    ok = [r for r in rows if all(x is not None and x == x for x in value_or_none(r, low + high))]
    return sorted(
        r for r in ok
        if not any(all(a <= b for a, b in zip(value(o), value(r))) and value(o) != value(r) for o in ok)
    )


def value_or_none(r, places):
    return [r[i] for i in places]


@pytest.mark.parametrize("tile", [50_000, 10])
def test_front_of_three_objectives(spark, monkeypatch, tile):
    import random

    from plumbline.operators import frontier

    monkeypatch.setattr(frontier, "TILE_POINTS", tile)
    rng = random.Random(tile)
    rows = [(i, *(float(rng.randint(0, 12)) for _ in range(3))) for i in range(400)]
    rows += [(900, None, 1.0, 2.0), (901, 0.0, float("nan"), 50.0), (902, 0.0, -1.0, 12.0), (903, -0.0, -1.0, 12.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double").repartition(20)
    got = sorted(map(tuple, pl.pareto_front_of(df, ["a", "b"], ["c"]).collect()))
    assert got == brute_front_of(rows, [1, 2], [3]) and {902, 903} <= {r[0] for r in got}
    one = {r.id for r in pl.pareto_front_of(df, ["a"]).collect()}
    assert one == {r[0] for r in rows if r[1] is not None and r[1] == 0.0}


def test_front_of_a_large_antichain_and_of_nothing(spark, monkeypatch):
    from plumbline.operators import frontier

    monkeypatch.setattr(frontier, "TILE_POINTS", 50)
    df = spark.range(300).selectExpr("id", "cast(id as double) a", "cast(300 - id as double) b", "cast(0 as double) c")
    assert pl.pareto_front_of(df, ["a", "b", "c"]).count() == 300
    assert pl.pareto_front_of(df.filter("false"), ["a", "b"], ["c"]).count() == 0
    with pytest.raises(ValueError):
        pl.pareto_front_of(df)
