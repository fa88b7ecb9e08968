"""Group means and counts, dense over two keys (A1-A4)."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, local_frame, number, present, require, small_rows
from ..staging import stage_table

# Spread of a long label list when the dense grid is laid out.
GRID_BUCKETS = 256
# Up to this many labels are literals in the plan.
LITERAL_LABELS = 500


def mean_by(df: DataFrame, x: str, y: str, hue: str | None = None, dense: bool = True) -> DataFrame:
    """Mean of y per x, or per (x, hue) with 0 for pairs that do not occur.

    ``dense=False`` leaves such pairs out: two long label lists have as many
    pairs as their product.
    """
    keys = require(df, [x] if hue is None else [x, hue])
    rows = present(df, keys).select(*[col(k) for k in keys], number(y).alias("_y"))
    found = rows.groupBy(*[col(k) for k in keys]).agg(
        F.sum("_y").alias("_s"), F.count("_y").alias("_c"), F.count(F.lit(1)).alias("_n")
    )
    if hue is not None and dense:
        found = fill_grid(found, [x], hue, ["_s", "_c", "_n"])
    mean = F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(F.try_divide("_s", "_c"))
    return found.select(*[col(k) for k in keys], mean.alias("mean"))


def count_by(df: DataFrame, x: str, hue: str | None = None, dense: bool = True) -> DataFrame:
    """Rows per x, or per (x, hue) with 0 for pairs that do not occur, unless not ``dense``."""
    keys = require(df, [x] if hue is None else [x, hue])
    found = (
        present(df, keys)
        .groupBy(*[col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return fill_grid(found, [x], hue, ["n"]) if hue is not None and dense else found


def fill_grid(found: DataFrame, left: Sequence[str], hue: str, values: Sequence[str]) -> DataFrame:
    """Add a zero row for every (left, hue) pair absent from grouped counts.

    All of ``left`` but its last column is shared by both label lists. The grid
    is the result asked for, one row per pair of labels. A short list of hue
    labels is laid out next to each left label; a long one by an equi join on a
    bucket of the label, so that many tasks share the work.
    """
    rows = small_rows(found)
    found = stage_table(found, "groups") if rows is None else local_frame(found.sparkSession, rows, found.schema)
    shared = list(left[:-1])
    names = [*left, hue]
    xs = found.select(*[col(c) for c in left]).distinct()
    labels = _labels(rows, shared, hue)
    if labels is not None:
        grid = xs.withColumn(hue, F.explode(_label_list(labels, shared, found.schema[hue].dataType)))
    else:
        hues = found.select(*[col(c) for c in shared], col(hue)).distinct()
        bucket = F.pmod(F.xxhash64(col(hue)), F.lit(GRID_BUCKETS)).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.lit(GRID_BUCKETS - 1)))
        grid = xs.withColumn("_g", spread).join(hues.withColumn("_g", bucket), [*shared, "_g"])
    zeros = [F.lit(0).cast(found.schema[v].dataType).alias(v) for v in values]
    return (
        found.select(*[col(c) for c in names], *[col(v) for v in values])
        .unionByName(grid.select(*[col(c) for c in names], *zeros))
        .groupBy(*[col(c) for c in names])
        .agg(*[F.sum(col(v)).alias(v) for v in values])
    )


def _labels(rows: list | None, shared: Sequence[str], hue: str) -> dict[tuple, list] | None:
    """Hue labels per shared key, or None when they are too many for a literal."""
    if rows is None:
        return None
    out: dict[tuple, dict] = {}
    for r in rows:
        out.setdefault(tuple(r[c] for c in shared), {})[r[hue]] = None
    return {k: list(v) for k, v in out.items()} if sum(map(len, out.values())) <= LITERAL_LABELS else None


def _label_list(labels: dict[tuple, list], shared: Sequence[str], kind: T.DataType) -> Column:
    choice = None
    for key, values in labels.items():
        listed = F.array(*[F.lit(v).cast(kind) for v in values])
        if not shared:
            return listed
        test = functools.reduce(lambda a, b: a & b, [col(c) == F.lit(v) for c, v in zip(shared, key)])
        choice = F.when(test, listed) if choice is None else choice.when(test, listed)
    return F.array().cast(T.ArrayType(kind)) if choice is None else choice


def long_categories(df: DataFrame, cats: Sequence[str], *others) -> DataFrame:
    """One row (variable, category, others...) per row and categorical column."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), col(c).cast("string").alias("category"))
            for c in require(df, cats)
        ]
    )
    return df.select(F.explode(cells).alias("cell"), *others).select(
        "cell.variable", "cell.category", "*"
    ).drop("cell")


def means_by(df: DataFrame, cats: Sequence[str], y: str) -> DataFrame:
    """``mean_by`` for many categorical columns in one scan: (variable, category, mean, n)."""
    rows = present(long_categories(df, cats, number(y).alias("_y")), ["category"])
    return rows.groupBy("variable", "category").agg(
        F.avg("_y").alias("mean"), F.count(F.lit(1)).alias("n")
    )


def counts_by(df: DataFrame, cats: Sequence[str], hue: str, dense: bool = True) -> DataFrame:
    """``count_by`` with hue for many columns: (variable, category, hue, n)."""
    rows = present(long_categories(present(df, [hue]), cats, col(hue).alias("hue")), ["category"])
    found = rows.groupBy("variable", "category", "hue").agg(F.count(F.lit(1)).alias("n"))
    return fill_grid(found, ["variable", "category"], "hue", ["n"]) if dense else found
