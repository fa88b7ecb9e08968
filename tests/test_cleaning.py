import pytest
from pyspark.sql import functions as F

import plumbline as pl

NAN = float("nan")


def test_spec_column_groups(spark):
    df = spark.createDataFrame([(1, 1.0, 2, "a", "t")], "id int, p double, q int, k string, text string")
    spec = pl.TableSpec("p", "numerical", ("k",), drop_cols=("text",), key=("id",))
    assert spec.numerics(df) == ["q"] and spec.categories(df) == ["k"]
    with pytest.raises(ValueError):
        pl.TableSpec("p", "numerical", ("k",), key=("id",)).numerics(df)
    with pytest.raises(ValueError):
        pl.TableSpec("p", "other")


def test_unknown_columns_are_errors(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        pl.drop_columns(df, ["nope"])
    with pytest.raises(ValueError):
        pl.select_features(df, ["nope"])
    with pytest.raises(ValueError):
        pl.select_features(df, [1, 0])


def test_drop_unlabeled_drops_nan_too(spark):
    df = spark.createDataFrame([(1, 1.0), (2, NAN), (3, None)], "id int, y double")
    assert [r["id"] for r in pl.drop_unlabeled(df, "y").collect()] == [1]


def test_clean_casts_joins_and_counts(spark):
    df = spark.createDataFrame([(1, "5", NAN), (2, "x", 1.0), (3, None, 2.0)], "id int, a string, b double")
    other = spark.createDataFrame([(1, "one"), (1, "uno")], "id int, word string")
    out = pl.clean(df, {"a": "int"}, [(other, ["id"])])
    rows = sorted(map(tuple, out.collect()), key=str)
    assert rows == [(1, 5, None, "one"), (1, 5, None, "uno"), (2, None, 1.0, None), (3, None, 2.0, None)]
    assert [tuple(r) for r in pl.failed_casts(df, {"a": "int"}).collect()] == [("a", 1)]


def test_featurizers_run_in_order(spark):
    chain = {
        "first": lambda df: df.withColumn("a", F.col("id") + 1),
        "second": lambda df: df.withColumn("b", F.col("a") * 10),
    }
    assert [tuple(r) for r in pl.apply_featurizers(spark.range(2), chain).collect()] == [(0, 1, 10), (1, 2, 20)]


def test_audit_counts_during_a_real_write(spark, tmp_path):
    audit = pl.StageAudit()
    df = audit.watch(spark.range(10), "read")
    df = audit.watch(df.filter("id > 3").withColumn("x", F.lit(1)), "filter")
    df.write.parquet(str(tmp_path / "out"))
    assert [tuple(r) for r in audit.table(run=False).collect()] == [
        ("read", 10, 1, "id"), ("filter", 6, 2, "id,x")
    ]


def test_polynomial_names_with_spaces_work_downstream(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, NAN, 1.0)], "a double, b double, c double")
    out = pl.poly_full(df, ["a", "b", "c"])
    assert out.columns == ["a", "b", "c", "a^2", "a b", "a c", "b^2", "b c", "c^2"]
    assert [tuple(r) for r in out.collect()][0] == (1, 2, 3, 1, 2, 3, 4, 6, 9)
    assert out.collect()[1]["a b"] is None
    stats = pl.profile_numeric(out, ["a b", "c^2"]).collect()
    assert {r["variable"]: r["n"] for r in stats} == {"a b": 1, "c^2": 2}
