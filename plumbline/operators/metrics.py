"""Scores over a prediction table (M1-M4, K4)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, safe_ratio


@dataclass(frozen=True)
class Metric:
    name: str
    higher_is_better: bool
    expr: Callable[[Column, Column], Column] | None  # None: needs the confusion table


def _mse(y: Column, p: Column) -> Column:
    return F.avg((y.cast("double") - p.cast("double")) ** 2)


def _r2(y: Column, p: Column) -> Column:
    y, p = y.cast("double"), p.cast("double")
    return 1 - safe_ratio(F.sum((y - p) ** 2), F.var_pop(y) * F.count(y))


def _accuracy(y: Column, p: Column) -> Column:
    return F.avg((y == p).cast("double"))


METRICS = {
    m.name: m
    for m in (
        Metric("mse", False, _mse),
        Metric("r2", True, _r2),
        Metric("matthews", True, None),
        Metric("accuracy", True, _accuracy),
    )
}


def metric_named(metric: str | Metric) -> Metric:
    if isinstance(metric, Metric):
        return metric
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; have {sorted(METRICS)}")
    return METRICS[metric]


def score(
    df: DataFrame, y: str, p: str, metric: str | Metric, by: Sequence[str] = ()
) -> DataFrame:
    """One ``score`` per group, all groups in one job."""
    metric = metric_named(metric)
    if metric.expr is None:
        return _matthews(df, y, p, list(by))
    return df.groupBy(*[col(b) for b in by]).agg(metric.expr(col(y), col(p)).alias("score"))


def _matthews(df: DataFrame, y: str, p: str, by: list[str]) -> DataFrame:
    """Multiclass Matthews correlation from the confusion counts.

    Each confusion cell adds to the total of its true class and of its predicted
    class, so the marginals need no join. A zero denominator scores 0.
    """
    keys = [col(b) for b in by]
    cells = df.groupBy(*keys, col(y).alias("_y"), col(p).alias("_p")).agg(
        F.count(F.lit(1)).cast("double").alias("_n")
    )
    zero = F.lit(0.0)
    hit = F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("_y").cast("string").alias("k"), F.col("_n").alias("t"), zero.alias("q"), hit.alias("c")),
        F.struct(F.col("_p").cast("string").alias("k"), zero.alias("t"), F.col("_n").alias("q"), zero.alias("c")),
    )
    # Class labels of y and p may differ in numeric type; compare as numbers there.
    if dict(df.dtypes)[y] != dict(df.dtypes)[p]:
        cells = cells.withColumns({"_y": F.col("_y").cast("double"), "_p": F.col("_p").cast("double")})
    marginals = (
        cells.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, F.col("s.k").alias("_k"))
        .agg(F.sum("s.t").alias("t"), F.sum("s.q").alias("q"), F.sum("s.c").alias("c"))
    )
    total, hits = F.sum("t"), F.sum("c")
    top = hits * total - F.sum(F.col("t") * F.col("q"))
    spread = (total * total - F.sum(F.col("q") ** 2)) * (total * total - F.sum(F.col("t") ** 2))
    return marginals.groupBy(*keys).agg(
        F.coalesce(safe_ratio(top, F.sqrt(spread)), F.lit(0.0)).alias("score")
    )


def mean_score(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean over splits and their number."""
    return scores.groupBy(*[col(b) for b in by]).agg(
        F.avg("score").alias("score"), F.count("score").alias("n_splits")
    )
