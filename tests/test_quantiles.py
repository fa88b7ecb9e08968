import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import plumbline as pl
from plumbline.operators import quantiles, splits


@pytest.fixture
def tiny(monkeypatch):
    """Force the narrowing path on small data."""
    monkeypatch.setattr(quantiles, "GATHER_ROWS", 5)
    monkeypatch.setattr(splits, "GATHER_ROWS", 5)
    monkeypatch.setattr(quantiles, "BINS", 7)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 20)


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("data", [
    np.random.default_rng(1).normal(size=400),
    np.concatenate([np.full(150, 3.0), np.arange(250) * 1.0]),
    np.concatenate([np.random.default_rng(2).normal(size=300), [1e300, -1e300, 1e-300]]),
    np.array([5.0] * 40),
    np.array([1.0, 2.0]),
])
def test_narrowing_equals_numpy(spark, tiny, data):
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,), (math.nan,)], "v double").repartition(4)
    assert pl.exact_quantiles(df, ["v"], PROBS)["v"] == pytest.approx(np.percentile(data, [100 * p for p in PROBS]).tolist())


def test_infinities_keep_their_rank(spark, tiny):
    values = [-math.inf] * 3 + [float(i) for i in range(20)] + [math.inf] * 2
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.values_at_ranks(df, [("v", r) for r in range(25)])
    assert [g.value for g in got] == values
    assert [got[0].below, got[3].below, got[24].below] == [0, 3, 23]


def test_large_whole_numbers_stay_exact(spark, tiny):
    base = 2**60
    values = [base + (i * 7919) % 101 for i in range(101)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = quantiles.values_at_ranks(df, [("v", 17), ("v", 100)])
    assert [g.value for g in got] == [base + 17, base + 100]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=80))
def test_direct_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = np.percentile(values, [100 * p for p in PROBS]).tolist()
    assert pl.exact_quantiles(df, ["v"], PROBS)["v"] == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_band_edges_and_missing(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, None, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["v"] for r in pl.quantile_band(df, "v").collect()]
    assert got == ["q25", "q25-75", "q25-75", "q75", "q75", None, None]


def test_band_of_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert pl.quantile_band(df, "v").collect()[0]["v"] is None


def test_fitted_bands_apply_elsewhere(spark):
    band = pl.QuantileBand("v").fit(spark.range(101).selectExpr("double(id) as v"))
    out = band.apply(spark.createDataFrame([(-5.0,), (25.0,), (99.0,)], "v double"))
    assert [r["v"] for r in out.collect()] == ["q25", "q25-75", "q75"]


def test_approximate_is_close(spark):
    df = spark.range(10001).selectExpr("double(id) as v")
    assert pl.exact_quantiles(df, ["v"], [0.5], approx=True)["v"][0] == pytest.approx(5000, abs=5)


@pytest.mark.parametrize("n,k", [(2003, 5), (10, 3), (7, 7), (60, 4)])
def test_contiguous_folds(spark, tiny, n, k):
    df = spark.range(n).selectExpr("(id * 7919) % 104729 as a", "id as b").repartition(3)
    rows = pl.kfold(df, ["a", "b"], k).orderBy("a", "b").collect()
    sizes = [n // k + (i < n % k) for i in range(k)]
    assert [r["fold"] for r in rows] == [f for f, s in enumerate(sizes) for _ in range(s)]


def test_folds_with_a_hot_first_key(spark, tiny):
    df = spark.range(900).selectExpr("if(id % 3 = 0, 0, id) as a", "id % 10 as b", "id as c")
    rows = pl.kfold(df, ["a", "b", "c"], 5).orderBy("a", "b", "c").collect()
    assert [r["fold"] for r in rows] == [i // 180 for i in range(900)]


def test_folds_reject_a_key_that_does_not_order(spark, tiny):
    with pytest.raises(ValueError):
        pl.kfold(spark.range(100).selectExpr("id * 0 as a"), "a", 5)
    with pytest.raises(TypeError):
        pl.kfold(spark.range(100).selectExpr("string(id) as a"), "a", 5)


def test_folds_by_date_key(spark):
    df = spark.range(10).selectExpr("date_add(date'2020-01-01', int(9 - id)) as d", "id")
    assert [r["fold"] for r in pl.kfold(df, "d", 2).orderBy("id").collect()] == [1] * 5 + [0] * 5


def test_shuffled_folds_do_not_depend_on_layout(spark):
    df = spark.range(2000)
    a = {r["id"]: r["fold"] for r in pl.kfold(df, "id", 5, shuffle=True, seed=7).collect()}
    b = {r["id"]: r["fold"] for r in pl.kfold(df.repartition(5), "id", 5, shuffle=True, seed=7).collect()}
    assert a == b and set(a.values()) == set(range(5))


def test_repeated_folds_cover_each_row_once(spark):
    rows = pl.repeated_kfold(spark.range(600), "id", 3, 4, seed=1).collect()
    assert len({(r["id"], r["rep"]) for r in rows}) == len(rows) == 2400
    by_rep = [{r["id"]: r["fold"] for r in rows if r["rep"] == rep} for rep in range(4)]
    assert by_rep[0] != by_rep[1]
    for folds in by_rep:
        sizes = [sum(f == g for f in folds.values()) for g in range(3)]
        assert min(sizes) > 130


def test_holdouts_share(spark):
    rows = pl.holdouts(spark.range(500), "id", n=10, test=0.3, seed=2).collect()
    assert len(rows) == 5000
    assert 0.25 < sum(r["is_test"] for r in rows) / 5000 < 0.35


def test_folds_lose_no_row_with_missing_keys(spark):
    df = spark.range(2_000).selectExpr("if(id % 100 = 0, null, id) as a", "if(id % 7 = 0, double('NaN'), id) as b", "id")
    for key in (["a", "id"], ["b", "id"]):
        sizes = {r["fold"]: r["n_rows"] for r in splits.fold_sizes(pl.kfold(df, key, 5)).collect()}
        assert sizes == {f: 400 for f in range(5)}
