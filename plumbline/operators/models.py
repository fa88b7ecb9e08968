"""Model families with one fit / predict / score surface."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LinearSVCModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import SMALL_ROWS, col, number, require, small_rows
from ..staging import staged
from .boosting import BINS, Booster, GridModel, LeafBoost
from .cells import DEPTH_BINS, MAX_CELLS, CellTrees, boost_cells, counted, gathered, viewed
from .gram import Ridge
from .metrics import Metric, metric_named, score
from .tube import EpsilonTube, TubeModel

FEATURES = "_features"
LABEL = "_label"
NUMBER = "_n"
# Training rows to a partition, and rows to a block that stays together.
ROWS_PER_PART = 100_000
BLOCK_ROWS = 8_192
# Classes that are told from the rest at the same time.
CONCURRENT_FITS = 4
# Equal rows that are dealt together, and rows that one task deals.
COPIES = 1_000
DEALT_ROWS = 250_000


# ---- search space ------------------------------------------------------------


@dataclass(frozen=True)
class LogUniform:
    low: float
    high: float

    def draw(self, rng: random.Random) -> float:
        return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class Integer:
    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)


# ---- kernel approximation ----------------------------------------------------


@dataclass(frozen=True)
class FourierFeatures:
    """Random Fourier features of the RBF kernel exp(-gamma |a - b|^2).

    Each feature is sqrt(2 / size) cos(w.x + b) with w ~ N(0, 2 gamma) and
    b uniform on [0, 2 pi), written as plain column expressions.
    """

    gamma: float
    size: int = 64
    seed: int = 0

    def weights(self, d: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The ``w`` and ``b`` of each feature of ``d`` columns, and the common factor."""
        rng = np.random.default_rng(self.seed)
        w = rng.normal(0.0, math.sqrt(2.0 * self.gamma), (self.size, d))
        b = rng.uniform(0.0, 2.0 * math.pi, self.size)
        return w, b, math.sqrt(2.0 / self.size)

    def columns(self, xs: Sequence[str]) -> list[Column]:
        w, b, scale = self.weights(len(xs))
        out = []
        for weights, shift in zip(w, b):
            angle = F.lit(float(shift))
            for x, weight in zip(xs, weights):
                angle = angle + col(x).cast("double") * F.lit(float(weight))
            out.append(F.cos(angle) * F.lit(scale))
        return out

    def vector(self, xs: Sequence[str]) -> Column:
        return array_to_vector(F.array(*self.columns(xs)))


# ---- families ----------------------------------------------------------------


@dataclass(frozen=True)
class ModelFamily:
    """How to build an estimator from parameters, and how to search them.

    ``build(params, n_rows, seed)`` returns a Spark ML estimator, a Ridge, a LeafBoost, a CellTrees or
    an EpsilonTube.
    ``kernel`` families see ``size`` random Fourier features of their columns; ``binary``
    ones are fitted once per class when there are more than two.
    """

    name: str
    classifier: bool
    build: Callable[[dict, int, int], object]
    defaults: dict = field(default_factory=dict)
    space: dict = field(default_factory=dict)
    metric: str = "mse"
    n_trials: int = 30
    kernel: bool = False
    binary: bool = False


class OneAgainstRest:
    """Binary models, one per class; the class of the highest raw score wins.

    Scores are combined by column expressions, so prediction stays in the JVM.
    """

    def __init__(self, models: Sequence):
        self.models = list(models)

    @classmethod
    def fit(cls, estimator, train: DataFrame, n_classes: int) -> OneAgainstRest:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)

        def one(k: int):
            return estimator.copy().fit(train.withColumn(LABEL, (F.col(LABEL) == float(k)).cast("double")))

        try:
            with ThreadPoolExecutor(min(n_classes, CONCURRENT_FITS)) as pool:
                models = list(pool.map(inheritable_thread_target(train.sparkSession)(one), range(n_classes)))
        finally:
            train.unpersist()
        return cls(models)

    def transform(self, df: DataFrame) -> DataFrame:
        scores = []
        for k, model in enumerate(self.models):
            # A copy leaves the training summary, which cannot be sent to tasks.
            model = model.copy().setPredictionCol("").setRawPredictionCol(f"_raw{k}")
            if hasattr(model, "setProbabilityCol"):
                model = model.setProbabilityCol("")
            df = model.transform(df)
            scores.append(F.element_at(vector_to_array(f"_raw{k}"), 2))
        found = F.array(*scores)
        best = F.array_position(found, F.array_max(found)) - 1
        return df.withColumn("prediction", best.cast("double"))


def _columns(seed: int | None = None) -> dict:
    out = {"featuresCol": FEATURES, "labelCol": LABEL}
    return out if seed is None else {**out, "seed": seed}


def _tree(cls):
    return lambda p, n, seed: cls(maxDepth=int(p["max_depth"]), **_columns(seed))


def _forest(cls):
    return lambda p, n, seed: CellTrees(
        "forest", p, seed, cls(maxDepth=int(p["max_depth"]), numTrees=int(p["n_estimators"]), **_columns(seed))
    )


def _svc(p: dict, n: int, seed: int):
    return LinearSVC(regParam=1.0 / (p["C"] * n), maxIter=int(p["max_iter"]), tol=1e-4, **_columns())


def _boosted(p: dict, seed: int) -> dict:
    return {
        "maxDepth": int(p["max_depth"]),
        "minInstancesPerNode": int(p["min_child_samples"]),
        "subsamplingRate": float(p["subsample"]),
        "maxIter": int(p["n_estimators"]),
        "stepSize": float(p["learning_rate"]),
        **_columns(seed),
    }



# Search ranges and trial counts of each family.
_SVM_SPACE = {"C": LogUniform(1e-2, 1e2), "gamma": LogUniform(1e-3, 1e3)}
_GBT_SPACE = {
    "subsample": Uniform(0.5, 1.0),
    "max_depth": Integer(1, 8),
    "min_child_samples": Integer(8, 128),
}
_GBT_DEFAULTS = {
    "max_depth": 5, "min_child_samples": 20, "subsample": 1.0, "n_estimators": 100, "learning_rate": 0.1
}
_LEAF_SPACE = {
    "num_leaves": Integer(2, 256),
    **_GBT_SPACE,
    "extra_trees": True,
    "reg_alpha": LogUniform(1e-8, 10.0),
    "reg_lambda": LogUniform(1e-8, 10.0),
}
_LEAF_DEFAULTS = {**_GBT_DEFAULTS, "num_leaves": 31, "extra_trees": False, "reg_alpha": 0.0, "reg_lambda": 0.0}

FAMILIES = {
    f.name: f
    for f in (
        ModelFamily(
            "ridge", False, lambda p, n, seed: Ridge(alpha=p["alpha"]),
            {"alpha": 1.0}, {"alpha": LogUniform(1e-3, 1e2)}, "mse", 10,
        ),
        ModelFamily(
            "svr", False, lambda p, n, seed: EpsilonTube(p), {"C": 1.0, "epsilon": 0.1, "gamma": 1.0, "max_iter": 100, "size": 64},
            {**_SVM_SPACE, "epsilon": LogUniform(1e-3, 1e2)}, "mse", 100, kernel=True,
        ),
        ModelFamily(
            "svc", True, _svc, {"C": 1.0, "gamma": 1.0, "max_iter": 100, "size": 64}, _SVM_SPACE, "matthews", 100,
            kernel=True, binary=True,
        ),
        ModelFamily(
            "gbt_reg", False, lambda p, n, seed: CellTrees("boost", p, seed, GBTRegressor(**_boosted(p, seed))),
            _GBT_DEFAULTS, _GBT_SPACE, "mse", 150,
        ),
        ModelFamily(
            "gbt_clf", True, lambda p, n, seed: CellTrees("boost", p, seed, GBTClassifier(**_boosted(p, seed))),
            _GBT_DEFAULTS, _GBT_SPACE, "matthews", 150, binary=True,
        ),
        ModelFamily(
            "leaf_reg", False, lambda p, n, seed: LeafBoost(p, seed), _LEAF_DEFAULTS, _LEAF_SPACE, "mse", 150,
        ),
        ModelFamily(
            "leaf_clf", True, lambda p, n, seed: LeafBoost(p, seed), _LEAF_DEFAULTS, _LEAF_SPACE, "matthews", 150,
        ),
        ModelFamily("tree_reg", False, _tree(DecisionTreeRegressor), {"max_depth": 5}, metric="r2"),
        ModelFamily("tree_clf", True, _tree(DecisionTreeClassifier), {"max_depth": 5}, metric="accuracy"),
        ModelFamily(
            "forest_reg", False, _forest(RandomForestRegressor),
            {"max_depth": 5, "n_estimators": 50}, metric="r2",
        ),
        ModelFamily(
            "forest_clf", True, _forest(RandomForestClassifier),
            {"max_depth": 5, "n_estimators": 50}, metric="accuracy",
        ),
    )
}


def family_named(family: str | ModelFamily) -> ModelFamily:
    if isinstance(family, ModelFamily):
        return family
    if family not in FAMILIES:
        raise ValueError(f"unknown model family {family!r}; have {sorted(FAMILIES)}")
    return FAMILIES[family]


def class_labels(df: DataFrame, y: str) -> list:
    """Sorted distinct classes of the target."""
    rows = small_rows(df.select(col(y)).dropna().distinct())
    if rows is None:
        raise ValueError(f"{y} has over {SMALL_ROWS} distinct values and cannot be a class target")
    return sorted(r[0] for r in rows)


def label_index(y: str, classes: Sequence) -> Column:
    table = F.create_map(*[F.lit(v) for i, c in enumerate(classes) for v in (c, float(i))])
    return F.try_element_at(table, col(y))


def class_of(prediction: Column, classes: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in classes]), prediction.cast("int") + 1)


class FittedModel:
    """A trained family member; ``predict`` adds a ``prediction`` column."""

    def __init__(self, family: ModelFamily, params: dict, xs: list[str], y: str, classes, model, seed: int):
        self.family, self.params, self.xs, self.y = family, params, xs, y
        self.classes, self.model, self.seed = classes, model, seed

    def predict(self, df: DataFrame) -> DataFrame:
        if isinstance(self.model, Ridge):
            return self.model.predict(df)
        if isinstance(self.model, GridModel):
            out = self.model.transform(df, self.xs)
        elif self.family.kernel and (linear := _linear_parts(self.model)):
            project = FourierFeatures(self.params["gamma"], int(self.params["size"]), self.seed).weights(len(self.xs))
            out = _kernel_said(df, self.xs, project, *linear)
        else:
            out = self.model.transform(with_features(df, self.family, self.params, self.xs, self.seed))
        if self.classes is not None:
            out = out.withColumn("prediction", class_of(F.col("prediction"), self.classes))
        return out.select(*[col(c) for c in df.columns], "prediction")

    def score(self, df: DataFrame, metric: str | Metric | None = None, by: Sequence[str] = ()) -> DataFrame:
        return score(self.predict(df), self.y, "prediction", metric_named(metric or self.family.metric), by)

    @property
    def importances(self) -> dict[str, float]:
        return dict(zip(self.xs, self.model.featureImportances.toArray().tolist()))


def _linear_parts(model) -> tuple[np.ndarray, np.ndarray, bool] | None:
    """A row of weights per output, the intercepts, and whether they tell classes."""
    if isinstance(model, TubeModel):
        return model.weights[None], np.array([model.intercept]), False
    own = model.models if isinstance(model, OneAgainstRest) else [model]
    if not all(isinstance(m, LinearSVCModel) and m.getThreshold() == 0.0 for m in own):
        return None
    return np.array([m.coefficients.toArray() for m in own]), np.array([m.intercept for m in own]), True


def _kernel_said(
    df: DataFrame, xs: Sequence[str], project: tuple, weights: np.ndarray, intercepts: np.ndarray, classes: bool
) -> DataFrame:
    """The rows with ``prediction``. Features are made once for equal rows of a batch."""
    shifted, shift, scale = project

    def scored(x: np.ndarray) -> np.ndarray:
        raw = scale * np.cos(x @ shifted.T + shift) @ weights.T + intercepts
        if not classes:
            return raw[:, 0]
        return (raw.argmax(1) if raw.shape[1] > 1 else raw[:, 0] > 0).astype("f8")

    @F.pandas_udf("double")
    def said(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in columns:
            x = [c.to_numpy() for c in part[: len(xs)]]
            code, sizes = np.zeros(len(part[0]), "i8"), []
            values = []
            for own in x:
                at, found = pd.factorize(own, use_na_sentinel=False)
                code = code * max(1, len(found)) + at
                sizes.append(max(1, len(found)))
                values.append(found)
            at, code = pd.factorize(code)
            if 2 * len(code) > len(at) or math.prod(sizes) >= 1 << 62:
                yield pd.Series(scored(np.column_stack(x)))
                continue
            rows = np.empty((len(code), len(xs)))
            for i in reversed(range(len(xs))):
                code, place = np.divmod(code, sizes[i])
                rows[:, i] = values[i][place]
            yield pd.Series(scored(rows)[at])

    given = [F.coalesce(col(x).cast("double"), F.raise_error(F.lit("missing values in the predictors")).cast("double")) for x in xs]
    # The iterator of one column comes bare; a constant keeps tuples for any number. NaN would come back as null.
    return df.withColumn("prediction", F.coalesce(said(*given, F.lit(0.0)), F.lit(math.nan)))


def with_features(df: DataFrame, family: ModelFamily, params: dict, xs: Sequence[str], seed: int) -> DataFrame:
    """Add the vector column. Missing values raise when a task meets one."""
    if family.kernel:
        return df.withColumn(FEATURES, FourierFeatures(params["gamma"], int(params["size"]), seed).vector(xs))
    names = [f"`{x}`" if "." in x else x for x in xs]
    return VectorAssembler(inputCols=names, outputCol=FEATURES, handleInvalid="error").transform(df)


def dealt(df: DataFrame, n_rows: int, seed: int = 0) -> DataFrame:
    """The rows with a block and a place in a random order that only they decide.

    Equal rows are counted and numbered, so neither the layout of the files nor
    the number of cores changes where a row comes, and no hot row piles up.
    The counted rows are small, so the number of tasks that write them out again
    follows from ``n_rows``: by size, Spark would leave them all to one.
    """
    cols = [col(c) for c in df.columns]
    step = F.lit(COPIES).cast("long")
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    parts = counted.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, step))
    ).repartition(1 + n_rows // DEALT_ROWS, *cols, "_from")
    last = F.least(F.col("_from") + step, F.col("_n")) - 1
    rows = parts.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
    place = F.xxhash64(*cols, F.col("_copy"), F.lit(seed))
    return rows.select(*cols, place.alias("_place")).withColumn(
        "_block", F.pmod("_place", F.lit(1 + n_rows // BLOCK_ROWS))
    )


def in_place(train: DataFrame, n_rows: int) -> DataFrame:
    """Dealt rows in partitions and an order that follow from the rows alone."""
    return train.repartition(1 + n_rows // ROWS_PER_PART, "_block").sortWithinPartitions("_block", "_place")


def fit_model(
    df: DataFrame,
    xs: Sequence[str],
    y: str,
    family: str | ModelFamily,
    params: dict | None = None,
    seed: int = 0,
    classes: Sequence | None = None,
    n_rows: int | None = None,
) -> FittedModel:
    """Train on the rows. The model depends on them, not on their layout.

    A frame that already has the columns of ``dealt`` is used in that order.
    """
    family = family_named(family)
    xs = require(df, xs)
    params = {**family.defaults, **(params or {})}
    if family.classifier and classes is None:
        classes = class_labels(df, y)
    if n_rows is None and not isinstance(family.build(params, 1, seed), Ridge):
        n_rows = df.count()
    estimator = family.build(params, n_rows or 1, seed)
    if isinstance(estimator, Ridge):
        return FittedModel(family, params, xs, y, None, estimator.fit(df, xs, y), seed)
    label = label_index(y, classes) if family.classifier else number(y)
    used = df.select(*[col(c) for c in dict.fromkeys([*xs, y])])
    own_classes = list(classes) if family.classifier else None
    if isinstance(estimator, (LeafBoost, CellTrees)):
        model = _fit_cells(used, xs, label, estimator, len(classes or ()), n_rows)
        if model is None and isinstance(estimator, LeafBoost):
            model = _fit_leaves(df, used, xs, label, estimator, len(classes or ()), n_rows)
        if model is not None:
            return FittedModel(family, params, xs, y, own_classes, model, seed)
        estimator = estimator.spark
    if isinstance(estimator, EpsilonTube):
        features = FourierFeatures(params["gamma"], int(params["size"]), seed).weights(len(xs))
        return FittedModel(family, params, xs, y, None, estimator.fit(used, xs, label, n_rows, features), seed)
    n_classes = len(classes) if family.binary and len(classes) > 2 else 0

    def fit(train: DataFrame, estimator) -> object:
        train = with_features(train, family, params, xs, seed)
        train = train.select(FEATURES, F.col(LABEL) if LABEL in train.columns else label.alias(LABEL), *[c for c in (NUMBER,) if c in train.columns])
        return OneAgainstRest.fit(estimator, train, n_classes) if n_classes else estimator.fit(train).copy()

    if _takes_weights(estimator):
        rows = counted(used.select(*[col(x) for x in xs], label.alias(LABEL)), min(MAX_CELLS, n_rows // 2))
        if rows is not None:
            with staged(rows, "counted") as table:
                return FittedModel(family, params, xs, y, own_classes, fit(*_weighted(table, estimator, n_rows, seed)), seed)
    if {"_block", "_place"} <= set(df.columns):
        used = df.select(*[col(c) for c in used.columns], "_block", "_place")
    else:
        used = dealt(used, n_rows)
    return FittedModel(family, params, xs, y, own_classes, fit(in_place(used, n_rows), estimator), seed)


def _fit_cells(
    used: DataFrame, xs: list[str], label: Column, estimator: LeafBoost | CellTrees, n_classes: int, n_rows: int
) -> GridModel | None:
    """Trees from the number of rows in each cell, or None if the cells are too many."""
    leaves = isinstance(estimator, LeafBoost)
    single = float(estimator.params["subsample"]) < 1.0 if leaves else estimator.single
    cells = gathered(viewed(used, xs, label), n_rows, BINS if leaves else DEPTH_BINS, n_classes, single)
    if cells is None:
        return None
    if leaves:
        return boost_cells(cells, Booster(dict(estimator.params), estimator.seed, cells.cuts, n_classes))
    return estimator.grow(cells, n_classes, used.sparkSession)


def _takes_weights(estimator) -> bool:
    """Whether equal rows weigh as much as their number, and no rule counts them one by one."""
    if isinstance(estimator, (DecisionTreeRegressor, DecisionTreeClassifier)):
        alone = estimator.getMinInstancesPerNode() == 1 and estimator.getMinWeightFractionPerNode() == 0.0
    else:
        alone = isinstance(estimator, LinearSVC)
    return alone and not estimator.isSet("weightCol")


def _weighted(table: DataFrame, estimator, n_rows: int, seed: int) -> tuple[DataFrame, object]:
    """Distinct rows in an order that follows from them, and the estimator that reads their number."""
    n_cells, squares = table.agg(F.count(F.lit(1)), F.sum(F.col(NUMBER).cast("double") ** 2)).first()
    place = F.xxhash64(*[col(c) for c in table.columns], F.lit(seed))
    rows = table.withColumn("_place", place).withColumn("_block", F.pmod("_place", F.lit(1 + n_cells // BLOCK_ROWS)))
    estimator = estimator.copy().setWeightCol(NUMBER)
    if isinstance(estimator, LinearSVC) and n_rows > 1:
        # Its spread of a weighted column has another divisor, and the penalty is on scaled weights.
        estimator = estimator.setRegParam(estimator.getRegParam() * (n_rows - squares / n_rows) / (n_rows - 1))
    return in_place(rows, n_cells), estimator


def _fit_leaves(
    df: DataFrame, used: DataFrame, xs: list[str], label: Column, estimator: LeafBoost, n_classes: int, n_rows: int
) -> Booster:
    """Sums of gradients do not ask for an order, so only a subsample has its rows dealt."""
    if estimator.params["subsample"] >= 1.0:
        return estimator.fit(used, xs, label, n_classes, n_rows, F.lit(0))
    placed = df if "_place" in df.columns else dealt(used, n_rows, estimator.seed)
    return estimator.fit(placed, xs, label, n_classes, n_rows, F.col("_place"))


def predict(model: FittedModel, df: DataFrame) -> DataFrame:
    return model.predict(df)
