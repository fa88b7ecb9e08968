import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.functions import columns
from plumbline.operators import encoding


def frame(spark, rows, schema="id int, k string"):
    return spark.createDataFrame(rows, schema)


FIT = [(1, "b"), (2, "a"), (3, "b"), (4, "c")]


def codes(df, name="k"):
    return [r[name] for r in df.orderBy("id").collect()]


def test_ordinal_first_appearance_and_alphabetical(spark):
    df = frame(spark, FIT)
    assert codes(pl.ordinal_encode(df, "k", "id")) == [1, 2, 1, 3]
    assert codes(pl.ordinal_encode(df, "k")) == [2, 1, 2, 3]


def test_unseen_and_missing(spark):
    apply = frame(spark, [(1, "a"), (2, "zzz"), (3, None)])
    plain = pl.OrdinalEncoder("k", "id").fit(frame(spark, FIT))
    assert codes(plain.apply(apply)) == [2, -1, -2]
    with_gap = pl.OrdinalEncoder("k", "id").fit(frame(spark, FIT + [(0, None)]))
    assert codes(with_gap.apply(apply)) == [3, -1, 1]


def test_onehot_unseen_is_all_zero(spark):
    encoder = pl.OneHotEncoder("k", "id").fit(frame(spark, FIT))
    out = encoder.apply(frame(spark, [(1, "c"), (2, "zzz"), (3, None)]))
    assert out.columns == ["id", "k_1", "k_2", "k_3"]
    assert [tuple(r)[1:] for r in out.orderBy("id").collect()] == [(0, 0, 1), (0, 0, 0), (0, 0, 0)]


def test_base_n_digits(spark):
    df = frame(spark, [(i, f"c{i:02d}") for i in range(1, 13)])
    out = pl.base_n_encode(df, "k", 10, "id").orderBy("id")
    assert out.columns == ["id", "k_0", "k_1"]
    assert [tuple(r) for r in out.collect()][8:12] == [(9, 0, 9), (10, 1, 0), (11, 1, 1), (12, 1, 2)]
    unseen = pl.BaseNEncoder("k", 10, "id").fit(df).apply(frame(spark, [(1, "zzz")]))
    assert [tuple(r) for r in unseen.collect()] == [(1, 0, 0)]


@pytest.mark.parametrize("literal,small", [(64, 10_000), (0, 10_000), (0, 2)])
def test_all_three_lookups_agree(spark, monkeypatch, literal, small):
    """Literal codes, broadcast mapping, and a mapping too large for the driver."""
    monkeypatch.setattr(encoding, "LITERAL_CODES", literal)
    monkeypatch.setattr(encoding, "small_rows", lambda df: columns.small_rows(df, small))
    rows = [(i, ["x", "y", None, "w", "x", "v"][i % 6], f"n{i % 4}") for i in range(48)]
    df = frame(spark, rows, "id int, k string, m string")
    out = pl.ordinal_encode(df, ["k", "m"], "id").orderBy("id").collect()
    assert [r["k"] for r in out][:6] == [1, 2, 3, 4, 1, 5]
    assert [r["m"] for r in out][:6] == [1, 2, 3, 4, 1, 2]
    mapping = pl.fit_categories(df, ["k", "m"])
    by_name = {(r["column"], r["category"]): r["code"] for r in mapping.collect()}
    assert by_name["k", "v"] == 1 and by_name["k", None] == 5 and by_name["m", "n3"] == 4
    back = pl.decode(pl.OrdinalEncoder(["k", "m"], "id").fit(df).apply(df),
                     pl.fit_categories(df, ["k", "m"], "id"), ["k", "m"])
    assert [tuple(r) for r in back.orderBy("id").collect()] == rows


def test_number_rows_over_many_parts(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("if(id % 3 = 0, 'a', 'b') as g", "id")
    out = encoding.number_rows(df, "g", [encoding.F.col("id").desc()], "n").collect()
    for g in "ab":
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["n"])
        assert [r["n"] for r in mine] == list(range(1, len(mine) + 1))
        assert [r["id"] for r in mine] == sorted((r["id"] for r in mine), reverse=True)


def test_standardize_population_sd_and_flat_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (float("nan"), 5.0)], "a double, c double")
    assert [tuple(r) for r in pl.standardize(df, ["a", "c"]).collect()] == [(-1, 0), (1, 0), (None, 0)]


def test_preprocessor_fits_once(spark):
    rows = [(i, float(i), f"t{i % 4}", f"s{i % 2}") for i in range(8)]
    df = frame(spark, rows, "id int, x double, t string, s string")
    spec = pl.TableSpec("id", "numerical", ("t", "s"))
    prep = pl.Preprocessor.of(df, spec, scaling=True, threshold=3).fit(df)
    out = prep.transform(df.limit(1), keep=["id"])
    assert out.columns == ["id", "st__x", "ord__t", "oh__s_1", "oh__s_2"]
    assert out.first()["st__x"] == pytest.approx(-3.5 / 5.25**0.5)
    later = prep.transform(frame(spark, [(9, 3.5, "new", "new")], "id int, x double, t string, s string"))
    assert tuple(later.first()) == (0.0, -1, 0, 0)


def test_cardinality_ignores_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (1.0, "b")], "x double, k string")
    for approx in (False, True):
        found = {r[0]: r[1] for r in pl.cardinality(df, ["x", "k"], approx).collect()}
        assert found == {"x": 1, "k": 2}


def test_distinct_values_order(spark):
    df = frame(spark, FIT + [(5, None)])
    assert [r[0] for r in pl.distinct_values(df, "k").collect()] == ["a", "b", "c"]
    assert [r[0] for r in pl.distinct_values(df, "k", "id").collect()] == ["b", "a", "c"]


def test_preprocessor_with_a_mapping_too_large_to_hold(spark, monkeypatch):
    monkeypatch.setattr(encoding, "small_rows", lambda df: columns.small_rows(df, 6))
    rows = [(i, f"t{i % 20:02d}", f"s{i % 2}") for i in range(40)]
    df = frame(spark, rows, "id int, t string, s string")
    prep = pl.Preprocessor([], ["t", "s"], order_by="id").fit(df)
    assert prep.ordinal == ["t"] and prep.onehot == ["s"]
    out = prep.transform(df, ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in out[:3]] == [(0, 1, 1, 0), (1, 2, 0, 1), (2, 3, 1, 0)]


def test_onehot_of_many_categories_is_a_vector(spark):
    from pyspark.ml.functions import vector_to_array

    n = 12_000
    df = spark.range(n).selectExpr("id", "concat('c', id) as k")
    out = pl.onehot_encode(df, "k")
    assert out.columns == ["id", "k"]
    rows = out.select("id", vector_to_array("k").alias("v")).filter("id % 4000 = 0").collect()
    order = sorted(f"c{i}" for i in range(n))
    for r in rows:
        assert len(r["v"]) == n and [i for i, x in enumerate(r["v"]) if x] == [order.index(f"c{r['id']}")]
    from plumbline.operators.encoding import OneHotEncoder

    unseen = OneHotEncoder("k").fit(df).apply(spark.createDataFrame([(1, "new")], "id long, k string"))
    assert sum(unseen.select(vector_to_array("k").alias("v")).first()["v"]) == 0


def test_columns_do_not_depend_on_other_columns(spark):
    df = spark.range(10_500).select(
        F.col("id").cast("string").alias("many"), F.element_at(F.array(*map(F.lit, "xyz")), (F.col("id") % 3 + 1).cast("int")).alias("few")
    )
    coded = pl.onehot_encode(df, ["few", "many"])
    assert coded.columns == ["many", "few_1", "few_2", "few_3"] and dict(coded.dtypes)["many"] == "vector"
    assert coded.agg(F.sum("few_1"), F.sum("few_2"), F.sum("few_3")).first() == (3500, 3500, 3500)
    assert [r[0] for r in pl.ordinal_encode(df, ["few", "many"]).filter("many = 1").select("few").collect()] == [1]


def test_long_labels_are_labels(spark):
    df = spark.createDataFrame([("a" * 2000, 1.0), ("b", 2.0), ("b", 3.0)], "k string, v double")
    assert pl.onehot_encode(df, ["k"]).columns == ["k_1", "k_2", "v"]
    from plumbline.operators.models import class_labels

    assert class_labels(df, "k") == ["a" * 2000, "b"]
