"""Plan checks: no pair-wise joins, no window over the whole table, pruned and pushed scans."""

import pytest

import __spark_entry__ as entry
import plumbline as pl

SF_DIR = "/root/testdata/sf0.001"
CHECKED = (
    "band_count_dense", "clean_join", "mean_by_hue", "count_by_hue", "histogram_hue", "pairwise_scatter",
    "associations", "profile_top_values", "univariate_class_target", "score_metrics", "pareto_front_lines",
    "ordinal_encode", "auto_encode", "kfold", "repeated_kfold_sizes", "compare_segments", "decode_classes",
)


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", CHECKED)
def test_no_pairwise_join_and_no_global_window(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for part in plan.split("\n\n"):
        if part.startswith("(") and "] Window" in part.split("\n")[0]:
            assert "Arguments: [], " not in part


def test_filter_and_columns_reach_the_files(spark):
    lines = pl.read_table(spark, f"{SF_DIR}/lineitem.parquet")
    plan = plan_of(pl.mean_by(lines.filter("l_discount > 0.05"), "l_returnflag", "l_tax"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThan(l_discount,0.05)" in pushed and "IsNotNull(l_returnflag)" in pushed
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert read == "ReadSchema: struct<l_discount:double,l_tax:double,l_returnflag:string>"


def test_histogram_rows_stay_in_one_stage(spark):
    """Bounds are broadcast, so only counted cells are shuffled."""
    lines = pl.read_table(spark, f"{SF_DIR}/lineitem.parquet")
    plan = plan_of(pl.histogram(lines, "l_tax", hue="l_returnflag"), "simple")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 1


def test_top_values_cut_before_the_shuffle(spark):
    parts = pl.read_table(spark, f"{SF_DIR}/part.parquet")
    assert plan_of(pl.top_values(parts, ["p_brand"], 5)).count("WindowGroupLimit") >= 2


def test_pareto_passes_do_not_shuffle_the_rows(spark):
    from plumbline.operators import frontier

    lines = pl.read_table(spark, f"{SF_DIR}/lineitem.parquet")
    points = lines.selectExpr("l_extendedprice as _a", "l_quantity as _b")
    kept, rows = frontier._above_earlier(points)
    assert "Exchange" not in plan_of(kept, "simple") and kept.count() < rows / 5


@pytest.mark.parametrize("name", ["repeated_kfold_rows", "holdout_rows"])
def test_repeats_of_a_row_are_not_shuffled(spark, name):
    """Rows meet by their key before they are repeated: one shuffle, and no copy per distinct count."""
    plan = plan_of(entry.queries()[name](spark, SF_DIR), "simple")
    assert "Expand" not in plan and plan.count("Exchange") == 1
    assert plan.index("Generate") < plan.index("Exchange")  # the shuffle is below, so it comes first
