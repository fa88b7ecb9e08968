import pytest
from pyspark.sql import functions as F

import plumbline as pl


def steps(spark):
    return spark.range(800).selectExpr(
        "id", "double(id % 8) as a", "double(id % 5) as b", "id % 3 as k",
        "if(id % 8 > 3, 10.0D, 0.0D) + if(id % 5 > 1, 1.0D, 0.0D) as y",
        "if(id % 8 > 3, 'up', if(id % 5 > 1, 'side', 'down')) as band",
    )


def test_rules_partition_the_rows_and_match_the_model(spark):
    df = steps(spark)
    spec = pl.TableSpec("y", "numerical", use_cols=("a", "b", "k"), key=("id",))
    tree = pl.explain_tree(df, spec, max_depth=2)
    rules = tree.rules().collect()
    assert sum(r["n"] for r in rules) == 800 and sum(r["share"] for r in rules) == pytest.approx(1)
    assert [(r["rule"], r["mean"]) for r in rules] == [
        ("a <= 3.5 and b <= 1.5", 0.0),
        ("b > 1.5 and a <= 3.5", 1.0),
        ("a > 3.5 and b <= 1.5", 10.0),
        ("a > 3.5 and b > 1.5", 11.0),
    ]
    predicted = tree.model.predict(df)
    means = {r["leaf"]: r["mean"] for r in rules}
    leaf_mean = F.element_at(F.create_map(*[F.lit(v) for p in means.items() for v in p]), F.col("_leaf"))
    assert tree.with_leaf(predicted).filter(F.abs(F.col("prediction") - leaf_mean) > 1e-9).count() == 0


def test_rule_text_filters_the_same_rows(spark):
    df = steps(spark)
    spec = pl.TableSpec("band", "categorical", use_cols=("a", "b", "k"), key=("id",))
    for r in pl.tree_rules(df, spec, max_depth=3).collect():
        inside = df.filter(r["rule"]) if r["rule"] != "all rows" else df
        assert inside.count() == r["n"] == sum(r["class_counts"].values())
        counts = {x["band"]: x["count"] for x in inside.groupBy("band").count().collect()}
        assert counts == r["class_counts"]


def test_nodes_add_up(spark):
    spec = pl.TableSpec("y", "numerical", use_cols=("a", "b"), key=("id",))
    nodes = {r["node"]: r for r in pl.tree_nodes(steps(spark), spec, max_depth=2).collect()}
    assert nodes[1]["n"] == 800 and nodes[1]["feature"] == "a" and nodes[1]["threshold"] == 3.5
    for r in nodes.values():
        assert sum(h["n"] for h in r["histogram"]) == r["n"]
        if r["left"]:
            assert r["n"] == nodes[r["left"]]["n"] + nodes[r["right"]]["n"]


def test_class_nodes_and_importance(spark):
    spec = pl.TableSpec("band", "categorical", use_cols=("a", "b", "k"), key=("id",))
    tree = pl.explain_tree(steps(spark), spec, max_depth=2)
    root = tree.nodes().first()
    assert {h["bin"] for h in root["histogram"]} == {0, 1, 2}
    ranked = tree.importance().collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3] and ranked[-1]["feature"] == "k"


def test_flat_target_is_one_leaf(spark):
    df = spark.range(50).selectExpr("double(id) as x", "1.0D as y")
    rules = pl.tree_rules(df, pl.TableSpec("y", "numerical")).collect()
    assert [(r["rule"], r["n"], r["mean"]) for r in rules] == [("all rows", 50, 1.0)]
