"""Comparing variables, variable lists and model families."""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number, require
from ..spec import TableSpec
from .encoding import encode_categories
from .models import FAMILIES
from .quantiles import exact_quantiles
from .subsets import MODELS, model_scorer, ridge_scorer
from .tuning import tune

# Finest grid: 2 ** GRID_POWER bins of equal frequency per side.
GRID_POWER = 3


def binned_mi(df: DataFrame, cols: Sequence[str], target: str, approx: bool = False) -> DataFrame:
    """(variable, score, bins_x, bins_y): normalized mutual information with the target.

    Both sides are cut at quantiles. Rows are counted once, on the finest grid;
    coarser grids of 2, 4, ... bins merge neighbours. The score is the best over
    the grids of information / log(smaller number of bins). It is not the
    maximal information coefficient, which searches unequal grids.
    """
    cols = require(df, cols)
    fine = 2**GRID_POWER
    cuts = exact_quantiles(df, [*cols, target], [i / fine for i in range(1, fine)], approx)
    values = df.select(*[number(c).alias(f"v{i}") for i, c in enumerate([*cols, target])])
    place = [_bin(F.col(f"v{i}"), cuts[c]) for i, c in enumerate([*cols, target])]
    cells = [F.lit(i * fine * fine) + p * fine + place[-1] for i, p in enumerate(place[:-1])]
    counted = (
        values.select(F.explode(F.array(*cells)).alias("cell"))
        .filter(F.col("cell").isNotNull())
        .groupBy("cell")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    powers = range(1, GRID_POWER + 1)
    grids = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in powers for b in powers])
    x = F.floor(F.col("cell") / fine) % fine
    merged = (
        counted.select(
            F.floor(F.col("cell") / (fine * fine)).cast("int").alias("i"),
            x.cast("int").alias("x"),
            (F.col("cell") % fine).cast("int").alias("y"),
            "n",
            F.explode(grids).alias("g"),
        )
        .select("i", "g.*", _merge("x", "g.a").alias("x"), _merge("y", "g.b").alias("y"), "n")
        .groupBy("i", "a", "b", "x", "y")
        .agg(F.sum("n").alias("n"))
    )
    grid = ["i", "a", "b"]

    def total(*keys: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*grid, *keys))

    # At most (2 ** GRID_POWER) ** 2 cells per grid.
    gain = F.col("n") / total() * F.ln(F.col("n") * total() / (total("x") * total("y")))
    scored = merged.withColumn("gain", gain).groupBy(*grid).agg(F.sum("gain").alias("mi"))
    share = F.col("mi") / (F.least("a", "b") * F.lit(math.log(2)))
    best = scored.withColumn("score", share).groupBy("i").agg(
        F.max(F.struct(F.round("score", 12).alias("score"), (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("best")
    )
    return best.select(
        F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1).alias("variable"),
        "best.score",
        F.pow(F.lit(2), -F.col("best.a")).cast("int").alias("bins_x"),
        F.pow(F.lit(2), -F.col("best.b")).cast("int").alias("bins_y"),
    )


def _bin(value: Column, cuts: Sequence[float]) -> Column:
    return functools.reduce(lambda a, b: a + b, [(value >= F.lit(c)).cast("int") for c in cuts])


def _merge(name: str, power: str) -> Column:
    """Bin on the coarser grid of 2 ** power bins."""
    return F.expr(f"cast(floor({name} / power(2, {GRID_POWER} - {power})) as int)")


def compare_subsets(
    df: DataFrame,
    spec: TableSpec,
    subsets: Mapping[str, Sequence[str]],
    model: str = "ridge",
    seed: int = 0,
    split: str | None = None,
) -> DataFrame:
    """(name, n, score) of named variable lists on the same splits."""
    features = spec.numerics(df) + spec.categories(df)
    coded = encode_categories(df, spec)
    masks = {name: tuple(int(f in set(require(df, xs))) for f in features) for name, xs in subsets.items()}
    wanted = list(dict.fromkeys(masks.values()))
    if model == "ridge":
        found = ridge_scorer(coded, spec, features, seed=seed, split=split)(wanted)
    else:
        with model_scorer(coded, spec, features, MODELS[model], seed=seed, split=split) as scorer:
            found = scorer(wanted)
    rows = [(name, sum(mask), found[mask]) for name, mask in masks.items()]
    return df.sparkSession.createDataFrame(rows, "name string, n int, score double")


def leaderboard(
    df: DataFrame,
    spec: TableSpec,
    families: Mapping[str, dict] | Sequence[str],
    metric: str | None = None,
    folds: int = 3,
    seed: int = 0,
    scaling: bool = True,
) -> DataFrame:
    """(family, metric, score, rank) of model families with given parameters on the same folds."""
    params = families if isinstance(families, Mapping) else {f: {} for f in families}
    metric = metric or ("mse" if spec.numerical_target else "matthews")
    rows = []
    for family, given in params.items():
        trial = {**FAMILIES[family].defaults, **given}
        tuned = tune(df, spec, family, metric=metric, folds=folds, repeats=1, seed=seed, scaling=scaling, trials=[trial])
        rows.append((family, metric, tuned.trial_scores().first()["score"]))
    rows.sort(key=lambda r: (r[2] if metric == "mse" else -r[2], r[0]))
    ranked = [(*r, i) for i, r in enumerate(rows, 1)]
    return df.sparkSession.createDataFrame(ranked, "family string, metric string, score double, rank int")
