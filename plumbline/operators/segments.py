"""Segments of a table: ridge per tree leaf, model trees, ranked leaves, clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, number
from ..spec import TableSpec
from .encoding import Standardizer, encode_categories
from .explain import Node, explain_tree, leaf_of, leaf_rules
from .gram import column_means, group_moments, scores_from_moments, solve
from .model_tree import grow
from .models import FEATURES, FAMILIES, with_features


def segment_ridge(
    df: DataFrame, spec: TableSpec, max_depth: int = 2, alpha: float = 1.0, seed: int = 0
) -> DataFrame:
    """A shallow tree, then a ridge model inside each leaf.

    (leaf, rule, n, r2, intercept, coef). All leaves are fitted from the sums of
    products of one pass grouped by leaf; r2 is on the leaf's own rows.
    """
    tree = explain_tree(df, spec, max_depth=max_depth, seed=seed)
    return _leaf_models(tree.frame, tree.root, tree.model.xs, spec.target, alpha)


def ridge_tree(
    df: DataFrame,
    spec: TableSpec,
    max_depth: int = 2,
    alpha: float = 1.0,
    split_on: Sequence[str] | None = None,
    regressors: Sequence[str] | None = None,
    min_rows: int = 50,
    min_gain: float = 0.001,
    bins: int = 64,
) -> DataFrame:
    """A tree grown for the ridge models in its leaves: same columns as ``segment_ridge``.

    A split is the one after which the two sides' ridge models leave the least squared error
    together, so slopes that differ are found even where the means do not. Splits are taken
    on ``split_on``, models use ``regressors``; both are all predictors by default, with
    categories as ordinal codes. Sides keep ``min_rows`` rows, and a split must take away a
    share ``min_gain`` of the table's squared deviation. Errors equal to one part in 10^9 go to
    the earlier column, then the smaller cut. Cuts are all values of a column with up to
    ``bins`` of them, else quantiles of at most about 100,000 rows; the two bins that meet at the
    best one are then cut once more into ``bins`` parts.

    A level sums, in two scans as far as memory allows, the products of the regressors per
    node, column and bin. Missing values are an error.
    """
    coded = encode_categories(df, spec)
    every = spec.numerics(df) + spec.categories(df)
    split_on, xs = list(split_on or every), list(regressors or every)
    root = grow(coded, split_on, xs, spec.target, max_depth, alpha, min_rows, min_gain, bins)
    return _leaf_models(coded, root, xs, spec.target, alpha)


def _leaf_models(frame: DataFrame, root: Node, xs: Sequence[str], target: str, alpha: float) -> DataFrame:
    """Ridge in every leaf, from sums of products of one pass grouped by leaf."""
    moments = group_moments(frame, xs, target, leaf_of(root))
    picks, rules, rows = range(1, len(xs) + 1), leaf_rules(root), []
    for leaf, block in sorted(moments.groups.items()):
        b = solve(block, picks, alpha)
        intercept = b[0] + moments.centre[-1] - moments.centre[:-1] @ b[1:]
        r2 = scores_from_moments(block, block, picks, alpha)["r2"]
        coef = {x: float(v) for x, v in zip(xs, b[1:])}
        rows.append((leaf, rules[leaf], int(round(block[0, 0])), r2, float(intercept), coef))
    return frame.sparkSession.createDataFrame(
        rows, "leaf int, rule string, n bigint, r2 double, intercept double, coef map<string,double>"
    )


def useful_segments(df: DataFrame, spec: TableSpec, max_depth: int = 3, seed: int = 0) -> DataFrame:
    """Leaves by how far their mean lies from the overall mean, times their share.

    (leaf, rule, n, share, mean, lift, weight); lift is in standard deviations
    of a numeric target.
    """
    rules = explain_tree(df, spec, max_depth=max_depth, seed=seed).rules()
    whole = df.agg(F.avg(number(spec.target)).alias("m"), F.stddev_pop(number(spec.target)).alias("s")).first()
    lift = (F.col("mean") - F.lit(whole["m"])) / F.lit(whole["s"] or 1.0)
    ranked = rules.withColumn("lift", lift).withColumn("weight", F.abs("lift") * F.col("share"))
    return ranked.orderBy(F.col("weight").desc(), "leaf")


def cluster_profile(
    df: DataFrame, cols: Sequence[str], k: int = 4, seed: int = 0, max_iter: int = 20
) -> DataFrame:
    """K-means on standardized columns: (cluster, n, variable, mean, sd) in original units."""
    cols = list(cols)
    column_means(df, cols)
    scaled = Standardizer(cols).fit(df)
    frame = df.select(*[number(c).alias(c) for c in cols], *[scaled.scaled(c).alias(f"_s{i}") for i, c in enumerate(cols)])
    vectors = with_features(frame, FAMILIES["tree_reg"], {}, [f"_s{i}" for i in range(len(cols))], seed)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=FEATURES, predictionCol="cluster").fit(vectors)
    groups = model.transform(vectors).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    cells = [
        F.struct(F.lit(c).alias("variable"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("sd"))
        for i, c in enumerate(cols)
    ]
    return groups.select("cluster", "n", F.explode(F.array(*cells)).alias("c")).select("cluster", "n", "c.*")
