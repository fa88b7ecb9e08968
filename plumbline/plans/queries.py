"""One query per operator over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import plumbline as pl

from ..functions.columns import col
from ..operators.cleaning import failed_casts
from ..operators.gram import group_moments
from ..operators.splits import fold_sizes
from ..sources.tables import load_sample
from ..staging import new_path
from ..spec import TableSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
LINE_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
PLANTED = "3 * l_quantity + 400 * l_discount"
SIGNALS = ("l_quantity", "l_discount")
NOISE = ("l_tax", "l_linenumber")


def query(func: Query) -> Query:
    QUERIES[func.__name__] = func
    return func


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pl.read_table(spark, f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(col(n), digits) for n in names})


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("y", F.expr(PLANTED))


def line_spec(target: str = "l_extendedprice", kind: str = "numerical") -> TableSpec:
    """lineitem with its order columns as key and the rest as predictors."""
    return TableSpec(
        target,
        kind,
        tuple(c for c in ("l_returnflag", "l_linestatus") if c != target),
        drop_cols=("l_shipdate", "l_partkey", "l_suppkey"),
        key=("l_orderkey", "l_linenumber"),
    )


def planted_spec(**options) -> TableSpec:
    return TableSpec("y", "numerical", use_cols=SIGNALS + NOISE, key=LINE_KEY, **options)


# ---- sources and cleaning -----------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Write CSV, read it back with inferred types.

    All columns, and with them 19-digit numbers, quotes and line breaks in cells.
    """
    path = new_path(spark, "lines") + ".csv"
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {
            "l_tax": F.when(col("l_tax") > 0, col("l_tax")),
            "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd"),
            "long_id": F.lit(1234567890123456789) + col("l_orderkey") * 1000 + col("l_linenumber"),
            "note": F.concat(F.lit('"'), "l_returnflag", F.lit('", said\n'), "l_linestatus", F.lit("\n")),
        }
    )
    pl.write_table(lines, path)
    return pl.read_table(spark, path)


@query
def csv_split(spark, sf_dir):
    """Texts with quotes and line breaks, written to CSV and read back by block."""
    path = new_path(spark, "texts") + ".csv"
    pl.write_table(table(spark, sf_dir, "documents"), path)
    texts = pl.read_table(spark, path, schema="doc_id bigint, text string, lang string, source string, n_chars bigint", multi_line="split")
    return texts.select("doc_id", "lang", "source", "n_chars", F.md5(col("text").cast("binary")).alias("text_md5"))


@query
def named_sample(spark, sf_dir):
    """A table by its name."""
    return load_sample(spark, sf_dir, "part")


@query
def parquet_stages(spark, sf_dir):
    """A table handed from the raw to the clean stage folder."""
    folders = pl.StageFolders(new_path(spark, "stages"))
    folders.write(table(spark, sf_dir, "orders"), "raw", "orders")
    raw = folders.read(spark, "raw", "orders")
    folders.write(pl.clean(raw, {"o_totalprice": "bigint"}), "clean", "orders")
    return folders.read(spark, "clean", "orders")


@query
def feature_sets_written(spark, sf_dir):
    """Base, poly1 and poly2 written; row and column sums of each read back."""
    paths = pl.write_feature_sets(
        table(spark, sf_dir, "lineitem"), line_spec(), new_path(spark, "features")
    )
    out = None
    for name, path in paths.items():
        back = pl.read_table(spark, path)
        last = back.columns[-1]
        part = back.agg(
            F.lit(name).alias("name"),
            F.lit(len(back.columns)).cast("bigint").alias("n_cols"),
            F.lit(last).alias("last_column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.round(F.sum(col(last)), 2).alias("last_sum"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def mapping_roundtrip(spark, sf_dir):
    """Category mapping written as JSON and read back."""
    path = new_path(spark, "mapping")
    cats = ["p_brand", "p_type"]
    pl.write_mapping(pl.fit_categories(table(spark, sf_dir, "part"), cats, "p_partkey"), path)
    return pl.read_mapping(spark, path)


@query
def drop_columns(spark, sf_dir):
    """P1."""
    return pl.drop_columns(table(spark, sf_dir, "orders"), ["o_orderdate", "o_custkey"])


@query
def drop_unlabeled(spark, sf_dir):
    """P2 on a label that is missing for the last line of long orders."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "label", F.when(col("l_linenumber") != 7, col("l_returnflag"))
    )
    return pl.drop_unlabeled(lines, "label").select(*LINE_ID, "label")


@query
def dropna_keys(spark, sf_dir):
    """P8 on two keys with gaps of their own."""
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_ID,
        F.when(col("l_tax") > 0, col("l_tax")).alias("a"),
        F.when(col("l_discount") > 0, col("l_discount")).alias("b"),
    )
    return pl.dropna_keys(lines, ["a", "b"])


@query
def clean_join(spark, sf_dir):
    """A text column made numeric where it can be, two tables joined."""
    orders = table(spark, sf_dir, "orders").withColumn("rank", _rank_text())
    return pl.clean(
        orders,
        {"rank": "int"},
        [
            (table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]),
            (table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"]),
        ],
    ).select("o_orderkey", "rank", "c_mktsegment", "c_acctbal", "n_name")


def _rank_text():
    """Priority digit, left as full text for finished orders."""
    return F.when(col("o_orderstatus") == "F", col("o_orderpriority")).otherwise(
        F.substring("o_orderpriority", 1, 1)
    )


@query
def failed_cast_counts(spark, sf_dir):
    """Values lost per cast."""
    orders = table(spark, sf_dir, "orders").withColumn("rank", _rank_text())
    return failed_casts(orders, {"rank": "int", "o_totalprice": "int", "o_orderstatus": "double"})


def unit_price(df: DataFrame) -> DataFrame:
    return df.withColumn("unit_price", col("l_extendedprice") / col("l_quantity"))


def net_price(df: DataFrame) -> DataFrame:
    return df.withColumn("net_price", col("unit_price") * (1 - col("l_discount")))


@query
def feature_chain(spark, sf_dir):
    """Two registered functions in order, then target | categories | numerics."""
    lines = pl.apply_featurizers(
        table(spark, sf_dir, "lineitem"), {"unit_price": unit_price, "net_price": net_price}
    )
    return pl.assemble_columns(lines, line_spec())


@query
def select_features(spark, sf_dir):
    """By mask over the numeric columns."""
    return pl.select_features(table(spark, sf_dir, "lineitem"), [1, 0, 1, 1], LINE_NUMBERS)


@query
def stage_audit(spark, sf_dir):
    """P10: rows and columns after each step, counted in one job."""
    audit = pl.StageAudit()
    lines = audit.watch(table(spark, sf_dir, "lineitem"), "read")
    kept = audit.watch(pl.drop_columns(lines, ["l_shipdate", "l_suppkey"]), "drop_columns")
    label = F.when(col("l_linenumber") != 7, col("l_returnflag"))
    labeled = audit.watch(
        pl.drop_unlabeled(kept.withColumn("l_returnflag", label), "l_returnflag"), "drop_unlabeled"
    )
    audit.watch(unit_price(labeled), "unit_price")
    return audit.table()


# ---- transforms ----------------------------------------------------------------


@query
def quantile_band(spark, sf_dir):
    """T1 on two columns."""
    lines = table(spark, sf_dir, "lineitem")
    return pl.quantile_band(lines, ["l_extendedprice", "l_quantity"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )


@query
def ordinal_encode(spark, sf_dir):
    """Codes by first appearance in key order."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag", "l_linestatus")
    return pl.ordinal_encode(lines, ["l_returnflag", "l_linestatus"], LINE_KEY)


@query
def onehot_encode(spark, sf_dir):
    """T3."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return pl.onehot_encode(parts, "p_type", "p_partkey")


@query
def base_n_encode(spark, sf_dir):
    """T4 in base 3."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return pl.base_n_encode(parts, "p_brand", 3, "p_partkey")


@query
def auto_encode(spark, sf_dir):
    """Brand by ordinal code, type one-hot."""
    return pl.auto_encode(table(spark, sf_dir, "part"), part_spec())


def part_spec() -> TableSpec:
    return TableSpec(
        "p_retailprice", "numerical", ("p_brand", "p_type"), drop_cols=("p_name",), key=("p_partkey",)
    )


@query
def poly_interactions(spark, sf_dir):
    """T5."""
    return pl.poly_interactions(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, LINE_ID)


@query
def poly_full(spark, sf_dir):
    """T6."""
    return pl.poly_full(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, LINE_ID)


@query
def standardize(spark, sf_dir):
    """T7."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ID, "l_quantity", "l_discount")
    return rounded(pl.standardize(lines, ["l_quantity", "l_discount"]), 6, "l_quantity", "l_discount")


@query
def preprocess(spark, sf_dir):
    """Scaled numerics, ordinal and one-hot categories, group names."""
    parts = table(spark, sf_dir, "part")
    prep = pl.Preprocessor.of(parts, part_spec(), scaling=True).fit(parts)
    return rounded(prep.transform(parts, keep=["p_partkey"]), 6, "st__p_size")


@query
def preprocess_plain(spark, sf_dir):
    """Neither scaled nor encoded, columns passed through."""
    parts = table(spark, sf_dir, "part")
    prep = pl.Preprocessor.of(parts, part_spec(), encode=False).fit(parts)
    return prep.transform(parts, keep=["p_partkey"])


@query
def decode_classes(spark, sf_dir):
    """Codes back to names."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    encoder = pl.OrdinalEncoder("o_orderpriority", "o_orderkey").fit(orders)
    coded = encoder.apply(orders, {"o_orderpriority": "code"})
    return pl.decode(coded.withColumn("name", col("code")).drop("o_orderpriority"),
                     encoder.mapping.withColumn("column", F.lit("name")), "name")


@query
def distinct_values(spark, sf_dir):
    """A17."""
    return pl.distinct_values(table(spark, sf_dir, "events"), "event_type")


# ---- profiling -------------------------------------------------------------------


@query
def mean_by(spark, sf_dir):
    """A1."""
    return rounded(pl.mean_by(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice"), 6, "mean")


@query
def count_by(spark, sf_dir):
    """A2."""
    return pl.count_by(table(spark, sf_dir, "events"), "event_type")


def located_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return pl.clean(table(spark, sf_dir, "customer"), joins=[(nation, ["c_nationkey"])])


@query
def mean_by_hue(spark, sf_dir):
    """A3: most (nation, region) pairs do not occur and show 0."""
    found = pl.mean_by(located_customers(spark, sf_dir), "n_name", "c_acctbal", "n_regionkey")
    return rounded(found, 6, "mean")


@query
def count_by_hue(spark, sf_dir):
    """A4."""
    return pl.count_by(located_customers(spark, sf_dir), "n_name", "n_regionkey")


@query
def count_by_many(spark, sf_dir):
    """A4 where the labels are more than the driver holds: every order and flag."""
    return pl.count_by(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")


@query
def mean_by_sparse(spark, sf_dir):
    """A3 without the absent pairs."""
    return rounded(
        pl.mean_by(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", "l_linenumber", dense=False), 6, "mean"
    )


@query
def ordinal_many(spark, sf_dir):
    """T2 over a few, thousands and tens of thousands of categories, each with its own kind of lookup."""
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_ID,
        col("l_shipdate").cast("date").cast("string").alias("day"),
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("line"),
        "l_returnflag",
    )
    return pl.ordinal_encode(pl.ordinal_encode(lines, ["day", "l_returnflag"]), "line")


@query
def band_count_dense(spark, sf_dir):
    """T1 then A4: return flags per price band."""
    lines = pl.quantile_band(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return pl.count_by(lines, "l_extendedprice", "l_returnflag")


@query
def histogram(spark, sf_dir):
    """A5, density."""
    found = pl.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return rounded(found.withColumn("height", col("height") * 1e6), 6, "left", "right", "height")


@query
def histogram_counts(spark, sf_dir):
    """A5, counts on a column whose values sit on the edges."""
    found = pl.histogram(table(spark, sf_dir, "lineitem"), "l_discount", bins=10, density=False)
    return rounded(found, 6, "left", "right")


@query
def histogram_hue(spark, sf_dir):
    """Edges per group."""
    found = pl.histogram(table(spark, sf_dir, "events"), "value", hue="event_type")
    return rounded(found, 6, "left", "right", "height")


@query
def scatter_bins(spark, sf_dir):
    """A7, cells per hue."""
    return pl.scatter_bins(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")


@query
def scatter_stats(spark, sf_dir):
    """A7, summary per hue."""
    found = pl.scatter_stats(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rounded(found, 6, "mean_x", "mean_y", "sd_x", "sd_y", "corr")


@query
def facet_bins(spark, sf_dir):
    """A9 by row and column facet."""
    return pl.facet_bins(
        table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag", bins=10
    )


@query
def facet_grid_width(spark, sf_dir):
    """Facets per row."""
    return pl.facet_grid_width(table(spark, sf_dir, "lineitem"), "l_linestatus")


@query
def pairwise_scatter(spark, sf_dir):
    """A8, cells."""
    return pl.pairwise_scatter(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, "l_returnflag", bins=8)


@query
def pairwise_stats(spark, sf_dir):
    """A8, correlations."""
    return rounded(pl.pairwise_stats(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, "l_returnflag"), 6, "corr")


@query
def target_correlation(spark, sf_dir):
    """A10, O1."""
    return rounded(pl.target_correlation(planted(spark, sf_dir), planted_spec()), 6, "corr")


@query
def associations(spark, sf_dir):
    """A12."""
    lines = planted(spark, sf_dir)
    found = pl.associations(lines, ["y", *SIGNALS, *NOISE], ["l_returnflag", "l_linestatus"])
    return rounded(found, 6, "value")


@query
def profile_numeric(spark, sf_dir):
    """A11, numeric columns."""
    found = pl.profile_numeric(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return rounded(found, 5, "mean", "sd", "min", "q25", "q50", "q75", "max", "skew", "kurtosis")


@query
def profile_categorical(spark, sf_dir):
    """A11, categorical columns."""
    return pl.profile_categorical(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"])


@query
def profile_top_values(spark, sf_dir):
    """A11, most frequent values."""
    return pl.top_values(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"], 5)


@query
def profile_report(spark, sf_dir):
    """A11 as one long table."""
    return rounded(pl.profile(table(spark, sf_dir, "part"), part_spec(), 3), 5, "value")


@query
def compare_segments(spark, sf_dir):
    """Shipped early against the rest."""
    lines = table(spark, sf_dir, "lineitem")
    found = pl.compare_segments(lines, col("l_linestatus") == "F", ["l_quantity", "l_extendedprice"])
    return rounded(found, 4, "inside", "outside", "difference")


@query
def univariate_numeric_target(spark, sf_dir):
    """Every predictor against a numeric target."""
    lines = table(spark, sf_dir, "lineitem")
    found = pl.univariate_profile(lines, line_spec(), bins=10, cells=10)
    return rounded(found, 5, "left", "right", "value")


@query
def univariate_class_target(spark, sf_dir):
    """Every predictor against a categorical target."""
    lines = table(spark, sf_dir, "lineitem")
    found = pl.univariate_profile(lines, line_spec("l_returnflag", "categorical"), bins=10)
    return rounded(found, 5, "left", "right", "value")


@query
def cardinality(spark, sf_dir):
    """A16."""
    return pl.cardinality(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_quantity", "l_returnflag", "l_shipdate"])


# ---- splits and scores -------------------------------------------------------------


@query
def kfold(spark, sf_dir):
    """K1: the fold of every row."""
    return pl.kfold(table(spark, sf_dir, "lineitem"), LINE_KEY).select(*LINE_KEY, "fold")


@query
def kfold_sizes(spark, sf_dir):
    """K1: the first n mod k folds hold one row more."""
    return fold_sizes(pl.kfold(table(spark, sf_dir, "lineitem"), LINE_KEY, k=7))


@query
def repeated_kfold_rows(spark, sf_dir):
    """K3: every row is tested once in each of ten repeats, and not always in the same fold."""
    # Rows meet before they are repeated, so a row moves once and not once per repeat.
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY).repartition(*LINE_KEY)
    dealt = pl.repeated_kfold(lines, LINE_KEY)
    return dealt.groupBy(*LINE_KEY).agg(
        F.count(F.lit(1)).alias("tests"),
        _distinct_reps(),
        F.count_if(col("fold").between(0, 2)).alias("in_range"),
        (F.max("fold") > F.min("fold")).cast("int").alias("varies"),
    )


def _distinct_reps():
    """Repeats that occur, up to 64 of them: a bit each, as a distinct count would copy the rows."""
    return F.expr("CAST(bit_count(bit_or(shiftleft(1L, rep))) AS BIGINT)").alias("reps")


@query
def repeated_kfold_sizes(spark, sf_dir):
    """K3: the folds of each repeat hold all rows, in near equal parts."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    sizes = fold_sizes(pl.repeated_kfold(lines, LINE_KEY), ["rep", "fold"])
    even = F.max("n_rows") - F.min("n_rows") < F.sum("n_rows") / 20
    return sizes.groupBy("rep").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_folds"),
        even.cast("int").alias("is_even"),
    )


@query
def holdout_rows(spark, sf_dir):
    """K2: every row once in each of thirty repeats, held out in some and not in others."""
    held = pl.holdouts(table(spark, sf_dir, "labels").repartition("doc_id"), "doc_id")
    return held.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"),
        _distinct_reps(),
        (F.count_if("is_test").between(1, 29)).cast("int").alias("both"),
    )


@query
def holdout_sizes(spark, sf_dir):
    """K2: thirty repeats with about 30 % test rows each."""
    held = pl.holdouts(table(spark, sf_dir, "labels"), "doc_id")
    share = F.avg(col("is_test").cast("int"))
    return held.groupBy("rep").agg(
        F.count(F.lit(1)).alias("n_rows"), share.between(0.15, 0.45).cast("int").alias("is_near")
    )


@query
def score_metrics(spark, sf_dir):
    """M1-M4: a deterministic guess of the line number, scored per return flag."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", col("l_linenumber").alias("y"), F.floor(col("l_quantity") / 8).cast("int").alias("p")
    )
    out = None
    for name in pl.METRICS:
        part = pl.score(lines, "y", "p", name, ["l_returnflag"]).withColumn("metric", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out, 6, "score")


@query
def mean_fold_score(spark, sf_dir):
    """A metric given as an expression, averaged over folds."""
    mae = pl.Metric("mae", False, lambda y, p: F.avg(F.abs(y - p)))
    folds = pl.kfold(table(spark, sf_dir, "lineitem"), LINE_KEY).withColumn("p", col("l_quantity") * 1500)
    scores = pl.score(folds, "l_extendedprice", "p", mae, ["fold"])
    return rounded(pl.mean_score(scores.withColumn("metric", F.lit("mae")), ["metric"]), 4, "score")


@query
def pareto_front(spark, sf_dir):
    """O2: small and expensive parts."""
    return pl.pareto_front(table(spark, sf_dir, "part"), "p_size", "p_retailprice").select(
        "p_partkey", "p_size", "p_retailprice"
    )


@query
def pareto_front_lines(spark, sf_dir):
    """O2 over lineitem: a first objective with almost as many values as rows."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "gain", col("l_quantity") * (1 - col("l_discount")) - col("l_tax")
    )
    return pl.pareto_front(lines, "l_extendedprice", "gain").select(*LINE_ID, "l_extendedprice", "gain")


@query
def pareto_front_three(spark, sf_dir):
    """O2 under three objectives over lineitem: cheap, many and with a large discount."""
    lines = table(spark, sf_dir, "lineitem")
    front = pl.pareto_front_of(lines, ["l_extendedprice"], ["l_quantity", "l_discount"])
    return front.select(*LINE_ID, "l_extendedprice", "l_quantity", "l_discount")


# ---- models, selection, search, explanation -----------------------------------------


@query
def ridge_fit(spark, sf_dir):
    """L3: two predictors, alpha 10."""
    lines = table(spark, sf_dir, "lineitem")
    model = pl.Ridge(10.0).fit(lines, ["l_quantity", "l_discount"], "l_extendedprice")
    return rounded(model.table(lines), 4, "value")


@query
def ridge_predict(spark, sf_dir):
    """L3: mean squared error and r2 of the fitted model on its own rows."""
    lines = table(spark, sf_dir, "lineitem")
    model = pl.fit_model(lines, ["l_quantity", "l_discount"], "l_extendedprice", "ridge", {"alpha": 10.0})
    scores = [model.score(lines, m).withColumn("metric", F.lit(m)) for m in ("mse", "r2")]
    return scores[0].unionByName(scores[1]).select("metric", F.round("score", 3).alias("score"))


@query
def subset_search_ridge(spark, sf_dir):
    """F2, F3 with K1: best subsets of at most two of four features."""
    front = pl.subset_search(
        planted(spark, sf_dir), planted_spec(), "ridge", max_features=2
    )
    return front.select("n", F.round("score", 6).alias("score"), F.array_join("selected", ",").alias("selected"))


@query
def subset_search_log(spark, sf_dir):
    """The log at the defaults: its length, and the best score at the end."""
    _, log = pl.subset_search_log(planted(spark, sf_dir), planted_spec(), "ridge", max_features=2)
    fell = F.col("max_score") < F.coalesce(F.lag("max_score").over(Window.orderBy("generation")), F.lit(0.0))
    return log.withColumn("fell", fell.cast("int")).agg(
        F.count("*").alias("n"),
        F.round(F.max_by("max_score", "generation"), 6).alias("best"),
        F.max_by("max_n", "generation").alias("max_n"),
        F.sum("fell").alias("falls"),
    )


#: More subsets than the search has places.
SEVEN = (*SIGNALS, *NOISE, "l_partkey", "l_suppkey", "l_extendedprice")


@query
def subset_search_tree(spark, sf_dir):
    """F2, O3 with decision trees, all generations, at most three columns: those that make up the target, the strongest first."""
    spec = TableSpec("y", "numerical", use_cols=SEVEN, key=LINE_KEY)
    front = pl.subset_search(planted(spark, sf_dir), spec, "DTR", max_features=3)
    return front.select("n", F.array_join("selected", ",").alias("selected"))


@query
def tune_ridge(spark, sf_dir):
    """H1, H2 with K3: ten penalties, as a share of the target's variance left over."""
    lines = table(spark, sf_dir, "lineitem")
    tuned = pl.tune(lines, line_spec(), "ridge", scaling=True)
    spread = lines.agg(F.var_pop("l_extendedprice")).first()[0]
    return tuned.trial_scores().select("trial", F.round(F.col("score") / spread, 2).alias("left_over"))


@query
def tune_boosted_trees(spark, sf_dir):
    """H1 over L7: the folds' scores for a class that the line number decides."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "half", F.when(col("l_linenumber") >= 4, "high").otherwise("low")
    )
    spec = TableSpec("half", "categorical", use_cols=("l_linenumber", "l_discount"), key=LINE_KEY)
    family = pl.FAMILIES["gbt_clf"]
    space = {**family.space, "n_estimators": 5}
    tuned = pl.tune(lines, spec, family, space, n_trials=2, folds=3, repeats=1)
    return tuned.trials.select("trial", "rep", "fold", F.round("score", 6).alias("score"))


@query
def tree_stump(spark, sf_dir):
    """L1, X1 at depth 1: the split of least squared error on l_discount."""
    spec = TableSpec("y", "numerical", use_cols=("l_discount",), key=LINE_KEY)
    rules = pl.tree_rules(planted(spark, sf_dir), spec, max_depth=1)
    return rounded(rules, 6, "share", "mean")


def _two_columns(target: str, kind: str) -> TableSpec:
    return TableSpec(target, kind, use_cols=("l_discount", "l_linenumber"), key=LINE_KEY)


@query
def tree_rules(spark, sf_dir):
    """X1 at depth 3 over two columns: greedy splits of least squared error."""
    rules = pl.tree_rules(planted(spark, sf_dir), _two_columns("y", "numerical"), max_depth=3)
    return rounded(rules.drop("rule"), 6, "share", "mean")


@query
def tree_rules_classes(spark, sf_dir):
    """X1 for a banded target at depth 2: greedy splits by class impurity."""
    lines = planted(spark, sf_dir).withColumn("y", 10 * col("l_linenumber") + col("l_quantity"))
    rules = pl.tree_rules(pl.quantile_band(lines, "y"), _two_columns("y", "categorical"), max_depth=2)
    return rules.select("leaf", "n", F.explode("class_counts").alias("class", "class_n"))


@query
def exact_tree(spark, sf_dir):
    """L1 with exact split points: two levels over a column of almost as many values as rows."""
    spec = TableSpec("l_quantity", "numerical", use_cols=("l_extendedprice", "l_tax"), key=LINE_ID)
    rules = pl.exact_tree(table(spark, sf_dir, "lineitem"), spec, max_depth=2).rules()
    return rules.select("leaf", "n", F.round("mean", 6).alias("mean"))


@query
def tree_two_levels(spark, sf_dir):
    """X1 at depth 2 over two columns: the best split of each half."""
    spec = TableSpec("y", "numerical", use_cols=("l_discount", "l_linenumber"), key=LINE_KEY)
    rules = pl.tree_rules(planted(spark, sf_dir), spec, max_depth=2)
    return rules.select("leaf", "n", F.round("mean", 6).alias("mean"))


@query
def tree_nodes(spark, sf_dir):
    """X2 at depth 2: every node's split and size."""
    nodes = pl.tree_nodes(planted(spark, sf_dir), _two_columns("y", "numerical"), max_depth=2)
    counted = F.aggregate("histogram", F.lit(0).cast("long"), lambda a, h: a + h["n"])
    return nodes.select("node", "feature", F.round("threshold", 6).alias("threshold"), "n", counted.alias("in_bins"))


@query
def stump_nodes(spark, sf_dir):
    """Target distribution at the root and both leaves, one row per bin."""
    spec = TableSpec("y", "numerical", use_cols=("l_discount",), key=LINE_KEY)
    nodes = pl.tree_nodes(planted(spark, sf_dir), spec, max_depth=1)
    return nodes.select("node", F.explode("histogram").alias("h")).select("node", "h.bin", "h.n")


@query
def feature_importance(spark, sf_dir):
    """Each column's share of the tree's gain."""
    tree = pl.explain_tree(planted(spark, sf_dir), _two_columns("y", "numerical"), max_depth=3)
    return rounded(tree.importance(), 6, "importance")


@query
def boruta(spark, sf_dir):
    """Selection written and read back; the columns that make up y are confirmed."""
    path = new_path(spark, "selection")
    pl.write_selection(pl.boruta(planted(spark, sf_dir), planted_spec()), path, "parquet")
    return spark.read.parquet(path).select("feature", "decision")


def _learned(spark, sf_dir, regressor: str | None, classifier: str | None, params: dict) -> DataFrame:
    """Predictions per line number for a square and for three named classes of it."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        (col("l_linenumber") * col("l_linenumber")).cast("double").alias("square"),
        F.element_at(F.array(*map(F.lit, ("one", "two", "three"))), col("l_linenumber") % 3 + 1).alias("name"),
    )
    out = []
    for family, target in ((regressor, "square"), (classifier, "name")):
        if family:
            model = pl.fit_model(lines, ["l_linenumber"], target, family, params)
            said = model.predict(lines)
            value = F.round("prediction", 6) if target == "square" else col("prediction")
            out.append(
                said.groupBy("l_linenumber", value.cast("string").alias("prediction"))
                .agg(F.count(F.lit(1)).alias("n")).withColumn("family", F.lit(family))
            )
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


@query
def forest_fit(spark, sf_dir):
    """L2, both kinds, with their default trees: targets that the line number decides."""
    return _learned(spark, sf_dir, "forest_reg", "forest_clf", {})


def _scaled_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.standardize(planted(spark, sf_dir), [*SIGNALS, "y"])


@query
def svr_kernel(spark, sf_dir):
    """The kernel model explains nearly all of a target that two columns make up, more than either does."""
    lines = _scaled_planted(spark, sf_dir)
    model = pl.fit_model(lines, list(SIGNALS), "y", "svr", {"gamma": 0.3, "C": 10.0})
    alone = lines.agg(*[F.pow(F.corr(c, "y"), F.lit(2)) for c in SIGNALS]).first()
    return model.score(lines, "r2").select(
        F.round("score", 1).alias("explained"), (F.col("score") > max(alone)).alias("above_one_column")
    )


@query
def svr_tube(spark, sf_dir):
    """L5 for a narrow and a wide band: rows, their mean distance beyond the band, and whether no constant comes as near."""
    lines = _scaled_planted(spark, sf_dir)
    middle = lines.agg(F.avg("y")).first()[0]
    out = None
    for epsilon in (0.2, 0.8):
        beyond = [F.avg(F.greatest(F.abs(col("y") - p) - epsilon, F.lit(0.0))) for p in (col("prediction"), F.lit(middle))]
        model = pl.fit_model(lines, list(SIGNALS), "y", "svr", {"gamma": 0.3, "C": 10.0, "epsilon": epsilon})
        part = model.predict(lines).agg(
            F.lit(epsilon).alias("epsilon"),
            F.count(F.lit(1)).alias("n"),
            F.round(beyond[0], 2).alias("beyond"),
            (beyond[0] < 0.1 * beyond[1]).alias("below_constant"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def svc_kernel(spark, sf_dir):
    """L4, three classes, all rows: each band is told right more often than by its share of the rows."""
    lines = pl.quantile_band(_scaled_planted(spark, sf_dir), "y")
    model = pl.fit_model(lines, list(SIGNALS), "y", "svc", {"gamma": 0.3, "C": 10.0})
    total = lines.count()
    right = F.avg((col("prediction") == col("y")).cast("int"))
    return model.predict(lines).groupBy(col("y").alias("band")).agg(
        F.count(F.lit(1)).alias("n"), (right > F.count(F.lit(1)) / total).alias("better_than_share")
    )


def _signal_facts(spark, sf_dir, regressor: str, classifier: str) -> DataFrame:
    """Facts of two models on all rows and four predictors, two of which make up the target."""
    lines = planted(spark, sf_dir)
    middle = lines.agg(F.avg("y")).first()[0]
    lines = lines.withColumn("half", F.when(col("y") >= middle, "high").otherwise("low"))
    xs, out = [*SIGNALS, *NOISE], None
    for family, target, metric, split in ((regressor, "y", "r2", "tree_reg"), (classifier, "half", "accuracy", "tree_clf")):
        model = pl.fit_model(lines, xs, target, family)
        stump = pl.fit_model(lines, xs, target, split, {"max_depth": 1})
        least = stump.score(lines, metric).first()["score"]
        weight = model.importances
        ranked = min(weight[c] for c in SIGNALS) > max(weight[c] for c in NOISE)
        part = model.score(lines, metric).select(
            F.lit(family).alias("family"),
            (F.col("score") > least).alias("above_one_split"),
            F.lit(bool(ranked)).alias("signals_first"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def forest_signals(spark, sf_dir):
    """L2, both kinds, with their default trees on four predictors."""
    return _signal_facts(spark, sf_dir, "forest_reg", "forest_clf")


@query
def gbt_signals(spark, sf_dir):
    """L6, L7 with their default rounds on four predictors."""
    return _signal_facts(spark, sf_dir, "gbt_reg", "gbt_clf")


@query
def gbt_reg(spark, sf_dir):
    """L6 with its default rounds."""
    return _learned(spark, sf_dir, "gbt_reg", None, {})


@query
def gbt_clf(spark, sf_dir):
    """L7, three classes."""
    return _learned(spark, sf_dir, None, "gbt_clf", {"n_estimators": 10})


#: Two stumps whose gains and leaves both penalties change.
LEAF_ROUNDS = {
    "n_estimators": 2, "num_leaves": 2, "learning_rate": 0.5, "reg_alpha": 5000.0, "reg_lambda": 1000.0,
    "min_child_samples": 1,
}


@query
def leaf_rounds(spark, sf_dir):
    """L6 grown by leaves: two penalised rounds, each on the gradients the one before leaves."""
    lines = planted(spark, sf_dir)
    model = pl.fit_model(lines, list(SIGNALS), "y", "leaf_reg", LEAF_ROUNDS)
    return model.predict(lines).groupBy(*SIGNALS).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("prediction"), 4).alias("prediction")
    )


@query
def leaf_signals(spark, sf_dir):
    """L6, L7 grown by leaves, with their default rounds on four predictors and all rows."""
    return _signal_facts(spark, sf_dir, "leaf_reg", "leaf_clf")


@query
def leaf_classes(spark, sf_dir):
    """L7 grown by leaves, three classes under one softmax."""
    return _learned(spark, sf_dir, None, "leaf_clf", {"n_estimators": 10})


@query
def tune_leaf_trees(spark, sf_dir):
    """H1 over L7 grown by leaves, with all its parameters and all thirty folds: scores of a class that the line number decides."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "half", F.when(col("l_linenumber") >= 4, "high").otherwise("low")
    )
    spec = TableSpec("half", "categorical", use_cols=("l_linenumber",), key=LINE_KEY)
    space = {**pl.FAMILIES["leaf_clf"].space, "n_estimators": 20, "extra_trees": False}
    tuned = pl.tune(lines, spec, "leaf_clf", space, n_trials=4)
    return tuned.trials.select("trial", "rep", "fold", F.round("score", 6).alias("score"))


# ---- goals named for the baseline ----------------------------------------------------


@query
def binned_mi(spark, sf_dir):
    """Information each column holds about the target."""
    found = pl.binned_mi(planted(spark, sf_dir), [*SIGNALS, *NOISE], "y")
    return rounded(found, 6, "score")


@query
def maximal_information(spark, sf_dir):
    """The best unequal grid of each column against two classes of the target."""
    lines = planted(spark, sf_dir).withColumn("big", (col("y") > 93).cast("int"))
    found = pl.maximal_information(lines, [*SIGNALS, *NOISE], "big", power=0.55)
    return found.select("variable", "n", F.round("score", 6).alias("score"))


@query
def ridge_tree(spark, sf_dir):
    """The cut of the tax after which a ridge on the quantity fits best on both sides."""
    steep = F.when(col("l_tax") > 0.035, 7 * col("l_quantity")).otherwise(180 - 7 * col("l_quantity"))
    lines = table(spark, sf_dir, "lineitem").withColumn("y", steep + 100 * col("l_discount"))
    spec = TableSpec("y", "numerical", use_cols=("l_tax", "l_quantity"), key=LINE_KEY)
    found = pl.ridge_tree(lines, spec, max_depth=1, split_on=["l_tax"], regressors=["l_quantity"])
    return found.select(
        "leaf", "n", F.round(F.col("coef")["l_quantity"], 3).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r2", 6).alias("r2")
    )


@query
def segment_ridge(spark, sf_dir):
    """A split on the discount, then ridge on it in each half."""
    spec = TableSpec("l_extendedprice", "numerical", use_cols=("l_discount",), key=LINE_KEY)
    found = pl.segment_ridge(table(spark, sf_dir, "lineitem"), spec, max_depth=1)
    return found.select("leaf", "n", F.round(F.col("coef")["l_discount"], 3).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query
def cluster_profile(spark, sf_dir):
    """Clusters hold every row once, and their means weigh up to the table's."""
    found = pl.cluster_profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], 3)
    return found.groupBy("variable").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("clusters"),
        F.round(F.sum(F.col("n") * F.col("mean")) / F.sum("n"), 3).alias("mean"),
    )


@query
def useful_segments(spark, sf_dir):
    """Leaves by lift times share."""
    spec = TableSpec("y", "numerical", use_cols=("l_discount",), key=LINE_KEY)
    found = pl.useful_segments(planted(spark, sf_dir), spec, max_depth=1)
    return found.select("leaf", "n", F.round("lift", 6).alias("lift"), F.round("weight", 6).alias("weight"))


@query
def product_stage(spark, sf_dir):
    """E5: prepared columns and target written for modelling, joined again by key."""
    parts = table(spark, sf_dir, "part")
    prep = pl.Preprocessor.of(parts, part_spec(), scaling=True).fit(parts)
    paths = pl.write_product(parts, part_spec(), pl.StageFolders(new_path(spark, "product")), prep)
    x, y = spark.read.parquet(paths["X"]), spark.read.parquet(paths["y"])
    return rounded(x.join(y, "p_partkey"), 6, "st__p_size")


@query
def compare_subsets(spark, sf_dir):
    """One signal, and both, on the same folds."""
    found = pl.compare_subsets(
        planted(spark, sf_dir), planted_spec(), {"reduced": ["l_quantity"], "both": list(SIGNALS)}
    )
    return rounded(found, 6, "score")


@query
def subset_splits(spark, sf_dir):
    """F2, E6 on documents: folds by a text key, by the whole row, and holdouts."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    docs = docs.select("source", "doc_id", "n_chars", "quality", (2 * col("n_chars") + 100 * col("quality")).alias("y"))
    out = None
    for name, key, split in (("text key", ("source",), "folds"), ("no key", (), "folds"), ("holdouts", ("doc_id",), "holdouts")):
        spec = TableSpec("y", "numerical", use_cols=("n_chars", "quality"), key=key)
        part = pl.compare_subsets(docs, spec, {"both": ["n_chars", "quality"]}, split=split)
        part = part.select(F.lit(name).alias("splits"), "n", F.round("score", 4).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def custom_family(spark, sf_dir):
    """A family and a scorer of one's own: a mask's score is its columns' squared correlation."""
    lines = planted(spark, sf_dir)
    family = pl.ModelFamily("stump", False, lambda p, n, seed: DecisionTreeRegressor(
        maxDepth=1, featuresCol="_features", labelCol="_label"), metric="r2")
    model = pl.fit_model(lines, ["l_linenumber"], "l_linenumber", family)
    own = model.score(lines).select(F.lit("stump").alias("name"), F.round("score", 6).alias("score"))
    row = lines.agg(*[F.pow(F.corr(c, "y"), F.lit(2)).alias(c) for c in (*SIGNALS, *NOISE)]).first()
    names = planted_spec().numerics(lines)
    best = pl.subset_search(
        lines, planted_spec(), max_features=1, generations=5, mu=10, lam=30,
        scorer=lambda masks: {m: sum(row[c] for c, keep in zip(names, m) if keep) for m in masks},
    )
    return own.unionByName(best.select(F.array_join("selected", ",").alias("name"), F.round("score", 6).alias("score")))


@query
def pairwise_wide(spark, sf_dir):
    """A8, A12 on wide rows: 120 pairs of vector places per half of the labels, with gaps."""
    rows = table(spark, sf_dir, "embeddings")
    places = [F.col("embedding")[i].cast("double").alias(f"e{i:02d}") for i in range(16)]
    rows = rows.select((col("label") % 2).alias("half"), *places)
    rows = rows.withColumn("e03", F.when(F.col("e03") > -0.1, F.col("e03")))
    return rounded(pl.pairwise_stats(rows, [f"e{i:02d}" for i in range(16)], "half"), 6, "corr")


@query
def wide_products(spark, sf_dir):
    """L3 on wide rows: sums of products of sixteen places of the vectors, per label."""
    rows = table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(16)]
    rows = rows.select("label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    found = group_moments(rows, names[:-1], names[-1], F.col("label"))
    at = [(g, i, j, float(m[i + 1, j + 1])) for g, m in sorted(found.groups.items()) for i in range(16) for j in range(i, 16)]
    made = spark.createDataFrame(at, "label int, i int, j int, product double")
    return made.select("label", "i", "j", F.round("product", 4).alias("product"))


@query
def leaderboard(spark, sf_dir):
    """Families on a linear target: ridge has no error, one split leaves its halves' spread, boosting less."""
    spec = TableSpec("y", "numerical", use_cols=SIGNALS, key=LINE_KEY)
    families = {"ridge": {}, "tree_reg": {"max_depth": 1}, "gbt_reg": {"n_estimators": 25, "max_depth": 3}}
    found = pl.leaderboard(planted(spark, sf_dir), spec, families)
    split = found.filter("family = 'tree_reg'").select("score").first()[0]
    known = F.when(col("family") != "gbt_reg", F.round(F.sqrt("score"), 0))
    return found.select("family", known.alias("error"), (col("score") < split).alias("below_one_split"))
