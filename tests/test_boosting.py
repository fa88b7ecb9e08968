import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import boosting
from plumbline.operators.splits import bucket, dealt_folds

XS = ["a", "b", "c"]


def table(spark, n=600, seed=0, parts=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 20, n), rng.integers(0, 9, n), rng.integers(0, 30, n)]).astype(float)
    y = x[:, 0] * 2 + np.where(x[:, 1] > 4, 15.0, 0.0) * (x[:, 2] > 9) + rng.normal(size=n)
    rows = [(i, *map(float, r), float(v), "xyz"[int(v > 20) + int(v > 40)]) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double, name string")
    return df.repartition(parts), x, y


def score(g, h, alpha, ridge):
    return max(abs(g) - alpha, 0.0) ** 2 / (h + ridge)


def grow(x, grad, hess, p):
    """Best leaf first, one split at a time."""
    def best(rows, depth):
        found = None
        if depth >= p["max_depth"]:
            return found
        g, h = grad[rows].sum(), hess[rows].sum()
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left = rows & (x[:, f] <= cut)
                right = rows & ~left
                if min(left.sum(), right.sum()) < p["min_child_samples"]:
                    continue
                gain = (
                    score(grad[left].sum(), hess[left].sum(), p["reg_alpha"], p["reg_lambda"])
                    + score(grad[right].sum(), hess[right].sum(), p["reg_alpha"], p["reg_lambda"])
                    - score(g, h, p["reg_alpha"], p["reg_lambda"])
                )
                if gain > 1e-6 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, left, right)
        return found

    leaves = [(np.ones(len(x), bool), 0)]
    options = [best(*leaves[0])]
    while len(leaves) < p["num_leaves"]:
        gains = [o[0] if o else -1.0 for o in options]
        at = int(np.argmax(gains))
        if gains[at] <= 0:
            break
        _, left, right = options.pop(at)
        depth = leaves.pop(at)[1] + 1
        for side in (left, right):
            leaves.append((side, depth))
            options.append(best(side, depth))
    out = np.zeros(len(x))
    for rows, _ in leaves:
        g = grad[rows].sum()
        pull = np.sign(g) * max(abs(g) - p["reg_alpha"], 0.0)
        out[rows] = -p["learning_rate"] * pull / (hess[rows].sum() + p["reg_lambda"])
    return out


def by_id(model, df):
    return np.array([r[0] for r in model.predict(df).orderBy("id").select("prediction").collect()])


@pytest.mark.parametrize(
    "given",
    [
        {"num_leaves": 5, "max_depth": 8},
        {"num_leaves": 31, "max_depth": 3, "reg_alpha": 20.0, "reg_lambda": 5.0},
        {"num_leaves": 12, "max_depth": 5, "min_child_samples": 60},
    ],
)
def test_regression_equals_growing_one_leaf_at_a_time(spark, given):
    df, x, y = table(spark)
    p = {**pl.FAMILIES["leaf_reg"].defaults, "learning_rate": 0.4, "n_estimators": 10, **given}
    want = np.full(len(y), y.mean())
    for _ in range(p["n_estimators"]):
        want += grow(x, want - y, np.ones(len(y)), p)
    assert by_id(pl.fit_model(df, XS, "y", "leaf_reg", p), df) == pytest.approx(want, abs=1e-5)


def test_two_classes_equal_growing_one_leaf_at_a_time(spark):
    df, x, y = table(spark)
    made = y > 20
    p = {**pl.FAMILIES["leaf_clf"].defaults, "n_estimators": 4, "num_leaves": 6, "reg_lambda": 1.0}
    margin = np.full(len(y), np.log(made.mean() / (1 - made.mean())))
    for _ in range(4):
        said = 1 / (1 + np.exp(-margin))
        margin += grow(x, said - made, said * (1 - said), p)
    model = pl.fit_model(df.withColumn("made", (F.col("y") > 20).cast("int")), XS, "made", "leaf_clf", p)
    assert by_id(model, df).tolist() == (margin > 0).astype(int).tolist()
    assert model.model.margins(boosting._bins(list(x.T), model.model.cuts))[:, 0] == pytest.approx(margin, abs=1e-6)


@pytest.mark.parametrize("given", [{}, {"subsample": 0.6}, {"extra_trees": True, "subsample": 0.8}])
def test_trees_do_not_depend_on_layout_or_on_small_scans(spark, given, monkeypatch):
    df, _, _ = table(spark)
    p = {"n_estimators": 3, "num_leaves": 8, **given}
    first = pl.fit_model(df, XS, "name", "leaf_clf", p).model.rounds
    assert pl.fit_model(df.repartition(7, "c"), XS, "name", "leaf_clf", p).model.rounds == first
    monkeypatch.setattr(boosting, "SCAN_BYTES", 8 * 3 * 3 * 30 * 2)  # two nodes a scan, added up by a shuffle
    monkeypatch.setattr(boosting, "ROUNDS_HELD", 1)
    again = pl.fit_model(df, XS, "name", "leaf_clf", p).model.rounds
    assert [[t.feature for t in r] for r in again] == [[t.feature for t in r] for r in first]
    assert [v for r in again for t in r for v in t.value] == pytest.approx([v for r in first for t in r for v in t.value])


def test_three_classes_are_learned_and_drawn_cuts_differ(spark):
    df, _, _ = table(spark)
    model = pl.fit_model(df, XS, "name", "leaf_clf", {"n_estimators": 30})
    assert model.score(df, "accuracy").first()["score"] > 0.95
    drawn = pl.fit_model(df, XS, "name", "leaf_clf", {"n_estimators": 30, "extra_trees": True})
    assert drawn.score(df, "accuracy").first()["score"] > 0.9
    assert drawn.model.rounds != model.model.rounds
    assert sum(model.importances.values()) == pytest.approx(1.0)


def test_trials_side_by_side_equal_single_fits(spark):
    df, _, _ = table(spark)
    spec = pl.TableSpec("y", "numerical", use_cols=tuple(XS), key=("id",))
    trials = [{"n_estimators": 3, "num_leaves": 4}, {"n_estimators": 5, "max_depth": 2, "reg_alpha": 3.0}]
    tuned = pl.tune(df, spec, "leaf_reg", trials=trials, folds=3, repeats=1)
    found = {(r["trial"], r["fold"]): r["score"] for r in tuned.trials.collect()}
    assert set(found) == {(t, f) for t in range(2) for f in range(3)}
    folds_of = dealt_folds(3, 0, 0)
    at = bucket(df, spec.key, 0)
    inside = F.element_at(F.array(*[F.lit(int(v)) for v in folds_of]), (at + 1).cast("int"))
    for trial, params in enumerate(trials):
        train, test = df.filter(inside != 1), df.filter(inside == 1)
        alone = pl.fit_model(train, XS, "y", "leaf_reg", params).score(test).first()["score"]
        assert found[trial, 1] == pytest.approx(alone, rel=1e-6)


def test_edges(spark):
    one = spark.createDataFrame([(1.0, 5.0, "k")] * 3, "a double, y double, name string")
    assert {r["prediction"] for r in pl.fit_model(one, ["a"], "y", "leaf_reg").predict(one).collect()} == {5.0}
    assert {r["prediction"] for r in pl.fit_model(one, ["a"], "name", "leaf_clf").predict(one).collect()} == {"k"}
    gap = spark.createDataFrame([(1.0, 5.0), (None, 3.0)], "a double, y double")
    with pytest.raises(Exception, match="missing values"):
        pl.fit_model(gap, ["a"], "y", "leaf_reg")
