import math

import numpy as np
import pytest

import plumbline as pl
from plumbline.operators import boruta as bo
from plumbline.operators import subsets


def planted(spark, n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    y = 3 * x[:, 0] + 2 * x[:, 1] + 0.1 * rng.normal(size=n)
    rows = [(i, *map(float, r), float(v), "hi" if v > 0 else "lo") for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(
        rows, "id int, a double, b double, c double, d double, e double, y double, band string"
    ).repartition(3), x, y


SPEC = pl.TableSpec("y", "numerical", use_cols=("a", "b", "c", "d", "e"), key=("id",))


def test_boruta_confirms_signal_and_rejects_noise(spark, tmp_path):
    df, _, _ = planted(spark)
    found = pl.boruta(df, SPEC, max_iter=12, params={"n_estimators": 8}, seed=1)
    decision = {r["feature"]: r["decision"] for r in found.collect()}
    assert decision["a"] == decision["b"] == "confirmed"
    assert [f for f, d in decision.items() if d == "rejected"] != []
    assert not {"c", "d", "e"} & {f for f, d in decision.items() if d == "confirmed"}
    assert [r["rank"] for r in found.filter("decision = 'confirmed'").collect()] == [1, 1]
    pl.write_selection(found, str(tmp_path / "s"))
    assert sorted(pl.selected_features(spark.read.json(str(tmp_path / "s")))) == ["a", "b"]


def test_boruta_with_classes_and_text_category(spark):
    rows = [(i, float(i % 7), "pqrs"[i % 4], "yes" if i % 4 < 2 else "no") for i in range(600)]
    df = spark.createDataFrame(rows, "id int, x double, k string, y string")
    spec = pl.TableSpec("y", "categorical", ("k",), key=("id",))
    found = pl.boruta(df, spec, max_iter=8, params={"n_estimators": 5})
    assert {r["feature"]: r["decision"] for r in found.collect()}["k"] == "confirmed"


def test_shadows_are_permutations_unrelated_to_the_originals(spark):
    df = spark.range(60_000).selectExpr("sin(id / 5000) as a", "double(id) as b", "id % 3 as y")
    mixed = bo.in_place(bo.dealt(df, 60_000), 60_000)
    names = ["s0", "s1", "s2"]
    order = ["_block", "_place"]
    out = bo.add_shadows(mixed, ["a", "b", "a"], names, 5).toPandas().sort_values(order, ignore_index=True)
    assert np.allclose(np.sort(out["a"]), np.sort(out["s0"])) and np.allclose(np.sort(out["b"]), np.sort(out["s1"]))
    corr = out[["a", "b", "s0", "s1", "s2"]].corr().abs()
    assert corr.loc["a", "s0"] < 0.02 and corr.loc["b", "s1"] < 0.02 and corr.loc["s0", "s2"] < 0.02
    assert corr.loc["s0", "s1"] < 0.02
    mixed = bo.in_place(bo.dealt(df.repartition(7), 60_000), 60_000)
    again = bo.add_shadows(mixed, ["a", "b", "a"], names, 5).toPandas().sort_values(order, ignore_index=True)
    assert again.equals(out)


def test_binomial_tail_and_step_up():
    assert bo.tail_at_least(8, 8) == 1 / 256 and bo.tail_at_least(0, 8) == 1
    assert bo.tail_at_least(7, 8) == pytest.approx(9 / 256)
    assert bo.stepped_up([0.01, 0.04, 0.03, 0.9], 0.05) == [True, False, False, False]
    assert bo.stepped_up([0.01, 0.02, 0.03, 0.9], 0.05) == [True, True, True, False]


def brute_scores(x, y, mask, k=5, alpha=1.0):
    n = len(y)
    xs = x[:, [bool(m) for m in mask]]
    cuts = np.cumsum([0] + [n // k + (i < n % k) for i in range(k)])
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        test = np.zeros(n, bool)
        test[lo:hi] = True
        xt, yt = xs[~test], y[~test]
        xm, ym = xt.mean(0), yt.mean()
        b = np.linalg.solve((xt - xm).T @ (xt - xm) + alpha * np.eye(xs.shape[1]), (xt - xm).T @ (yt - ym))
        res = y[test] - ym - (xs[test] - xm) @ b
        out.append(1 - (res**2).sum() / ((y[test] - y[test].mean()) ** 2).sum())
    return float(np.mean(out))


def test_ridge_masks_score_as_brute_force(spark):
    df, x, y = planted(spark)
    scorer = subsets.ridge_scorer(df, SPEC, ["a", "b", "c", "d", "e"])
    masks = [(1, 0, 0, 0, 0), (1, 1, 0, 0, 1), (0, 0, 1, 1, 0)]
    got = scorer(masks)
    assert [got[m] for m in masks] == pytest.approx([brute_scores(x, y, m) for m in masks])


def test_subset_search_front(spark):
    df, x, y = planted(spark)
    front, log = pl.subset_search_log(df, SPEC, "ridge", max_features=3, generations=8, mu=16, lam=40)
    rows = front.collect()
    sizes = [r["n"] for r in rows]
    assert {r["n"]: r["selected"] for r in rows}[2] == ["a", "b"]
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)
    assert sizes == sorted(sizes, reverse=True) and max(sizes) <= 3
    assert log.count() == 9 and log.filter("max_score < min_score").count() == 0


def test_small_table_uses_holdouts(spark):
    df, _, _ = planted(spark, n=300)
    rows = pl.subset_search(df, SPEC, "ridge", max_features=2, generations=5, mu=10, lam=20).collect()
    assert rows[0]["selected"] == ["a", "b"] and rows[0]["score"] > 0.9


def test_tree_masks_and_custom_scorer(spark):
    df, _, _ = planted(spark)
    calls = []

    def scorer(masks):
        calls.extend(masks)
        return {m: float(m[0] + m[2]) for m in masks}

    rows = pl.subset_search(df, SPEC, "DTC", max_features=2, generations=6, mu=20, lam=40, scorer=scorer).collect()
    assert [(r["n"], r["selected"]) for r in rows][0] == (2, ["a", "c"])
    assert len(calls) == len(set(calls)) and all(0 < sum(m) <= 2 for m in calls)
    spec = pl.TableSpec("band", "categorical", use_cols=("a", "c"), key=("id",))
    rows = pl.subset_search(df, spec, "DTC", max_features=1, generations=1, mu=4, lam=6, max_depth=2).collect()
    assert rows[0]["selected"] == ["a"] and rows[0]["score"] > 0.7
    with pytest.raises(ValueError):
        pl.subset_search(df, SPEC, "SVM")


def test_more_allowed_than_present(spark):
    df, _, _ = planted(spark)
    rows = pl.subset_search(df, SPEC, "ridge", max_features=50, generations=2, mu=8, lam=10).collect()
    assert rows and max(r["n"] for r in rows) <= 5


def test_ranks_and_crowding():
    fits = [(1, 0.5), (2, 0.9), (2, 0.4), (1, 0.5), (3, 0.95), (math.inf, 0.0), (3, 0.2)]
    assert [sorted(f) for f in subsets._fronts(fits)] == [[0, 1, 3, 4], [2], [6], [5]]
    population = [(i,) for i in range(len(fits))]
    assert set(subsets.keep_best(population, fits, 5)) == {(0,), (1,), (3,), (4,), (2,)}
    front = [(1, 0.1), (2, 0.2), (3, 0.21), (4, 0.9)]
    gap = subsets._crowding([0, 1, 2, 3], front)
    assert gap[0] == gap[3] == math.inf and gap[2] > gap[1]


def brute_ranks(fits):
    left, out = set(range(len(fits))), []
    while left:
        front = {
            i for i in left
            if not any(fits[j][0] <= fits[i][0] and fits[j][1] >= fits[i][1] and fits[j] != fits[i] for j in left)
        }
        out.append(sorted(front))
        left -= front
    return out


@pytest.mark.parametrize("seed", range(5))
def test_ranks_equal_pairwise_domination(seed):
    rng = np.random.default_rng(seed)
    fits = [(float(a), float(b) / 10) for a, b in zip(rng.integers(1, 6, 60), rng.integers(0, 10, 60))]
    assert [sorted(f) for f in subsets._fronts(fits)] == brute_ranks(fits)
