"""Parameter search by repeated cross-validation (H1-H3)."""

from __future__ import annotations

import functools
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, number, small_rows
from ..spec import TableSpec
from ..staging import staged
from .binned import bin_cuts
from .boosting import BINS, SIDE_BY_SIDE, Booster, LeafBoost, binned_rows, boost, held_out, spread_out
from .cells import (
    DEPTH_BINS,
    CellTrees,
    boost_cells,
    can_score,
    cells_of,
    equal_rows,
    score_cells,
    ungrouped,
    viewed,
)
from .encoding import MISSING, UNSEEN, Preprocessor
from .gram import Moments, group_moments, scores_from_moments
from .metrics import Metric, metric_named, score
from .models import (
    FAMILIES,
    FittedModel,
    ModelFamily,
    class_labels,
    class_of,
    dealt,
    family_named,
    fit_model,
    in_place,
    label_index,
)
from .splits import BUCKETS, bucket, dealt_folds, repeat_fold

CONCURRENT_FITS = 4
TRIALS_SCHEMA = "trial int, params map<string,double>, rep int, fold int, score double"


@dataclass
class Tuned:
    """Best model refitted on all rows, with the preprocessing it was fitted on."""

    trials: DataFrame
    best: dict
    preprocessor: Preprocessor
    model: FittedModel
    keep: list[str]
    metric: Metric

    def predict(self, df: DataFrame) -> DataFrame:
        """Prepared columns, the kept ones, and ``prediction``."""
        keep = [c for c in self.keep if c in df.columns]
        return self.model.predict(self.preprocessor.transform(df, keep))

    def score(self, df: DataFrame) -> DataFrame:
        return score(self.predict(df), self.model.y, "prediction", self.metric)

    def trial_scores(self) -> DataFrame:
        """(trial, params, score): mean over all folds, best first."""
        mean = F.avg("score")
        order = F.col("score").desc() if self.metric.higher_is_better else F.col("score").asc()
        return (
            self.trials.groupBy("trial").agg(F.first("params").alias("params"), mean.alias("score"))
            .orderBy(order, "trial")
        )


def draw_params(space: dict, n_trials: int, seed: int) -> list[dict]:
    """Seeded random draws; a value without ``draw`` is used as it is."""
    rng = random.Random(seed)
    return [
        {name: dist.draw(rng) if hasattr(dist, "draw") else dist for name, dist in space.items()}
        for _ in range(n_trials)
    ]


def tune(
    df: DataFrame,
    spec: TableSpec,
    family: str | ModelFamily,
    space: dict | None = None,
    n_trials: int | None = None,
    metric: str | Metric | None = None,
    folds: int = 3,
    repeats: int = 10,
    seed: int = 0,
    scaling: bool = False,
    encode: bool = True,
    threshold: int = 10,
    trials: Sequence[dict] | None = None,
    fit_on_all: bool = False,
) -> Tuned:
    """Score parameter sets by repeated k-fold, refit the best on all rows.

    ``trials`` gives explicit parameter sets instead of draws. Preprocessing is
    fitted on each training fold; ``fit_on_all`` fits it once on all rows.
    """
    family = family_named(family)
    metric = metric_named(metric or family.metric)
    if trials is None:
        trials = draw_params(space or family.space, n_trials or family.n_trials, seed)
    keep = [*spec.key, spec.target]
    prep = Preprocessor.of(df, spec, scaling=scaling, encode=encode, threshold=threshold).fit(df)
    used = [col(c) for c in dict.fromkeys([*keep, *prep.numeric, *prep.categorical])]
    # The buckets come from the raw rows, so all families share their folds.
    dealt_out = df.select(*used, bucket(df, spec.key, seed).alias("_bucket"))
    how = (dealt_out, spec, prep, family, trials, metric, folds, repeats, seed, fit_on_all)
    moments = None
    if family.name == "ridge" and metric.name in ("mse", "r2"):
        if fit_on_all or not (encode and prep.categorical):
            rows, moments = _ridge_trials(*how)
        else:
            rows = _ridge_fold_trials(*how)
    else:
        one_code = fit_on_all or not (encode and prep.categorical)
        rows = _cell_trials(*how) if one_code else None
        if rows is None:
            leaves = isinstance(family.build({**family.defaults, **trials[0]}, 1, seed), LeafBoost)
            rows = _boost_trials(*how) if leaves and one_code else _model_trials(*how)
    sums: dict[int, list[float]] = {}
    for trial, _, _, _, value in rows:
        if value is not None:
            sums.setdefault(trial, []).append(value)
    if not sums:
        raise ValueError("no trial could be scored")
    mean = {t: sum(v) / len(v) for t, v in sums.items()}
    choose = max if metric.higher_is_better else min
    best_trial = choose(sorted(mean), key=lambda t: mean[t])
    best = {**family.defaults, **trials[best_trial]}
    full = prep.transform(df, keep)
    xs = [c for c in full.columns if c not in keep]
    if moments is not None:
        ridge = family.build(best, moments.n_rows, seed).from_moments(moments)
        model = FittedModel(family, best, xs, spec.target, None, ridge, seed)
    else:
        model = fit_model(full, xs, spec.target, family, best, seed)
    table = df.sparkSession.createDataFrame(rows, TRIALS_SCHEMA)
    return Tuned(table, best, prep, model, keep, metric)


def _as_row(trial: int, params: dict, rep: int, fold: int, value: float | None) -> tuple:
    return trial, {k: float(v) for k, v in params.items()}, rep, fold, None if value is None else float(value)


def _ridge_trials(
    df: DataFrame, spec: TableSpec, prep: Preprocessor, family: ModelFamily, trials: Sequence[dict],
    metric: Metric, folds: int, repeats: int, seed: int, fit_on_all: bool,
) -> tuple[list[tuple], Moments]:
    """All trials and folds from one pass: products are summed per bucket.

    Scaling by a training fold's own spread is applied to the sums.
    """
    keep = [*dict.fromkeys([*spec.key, spec.target])]
    coded = prep.transform(df, [*keep, "_bucket"])
    xs = [c for c in coded.columns if c not in (*keep, "_bucket")]
    moments = group_moments(coded, xs, spec.target, F.col("_bucket"))
    picks = range(1, len(xs) + 1)
    scaled = [] if fit_on_all else [i for i, x in enumerate(xs, 1) if x.startswith("st__")]
    rows = []
    for rep in range(repeats):
        folds_of = dealt_folds(folds, rep, seed)
        parts = [
            (
                moments.total([b for b in range(BUCKETS) if folds_of[b] != f]),
                moments.total([b for b in range(BUCKETS) if folds_of[b] == f]),
            )
            for f in range(folds)
        ]
        for at, params in enumerate(trials):
            for f, (train, test) in enumerate(parts):
                value = scores_from_moments(train, test, picks, params["alpha"], scaled)[metric.name]
                rows.append(_as_row(at, params, rep, f, value))
    return rows, moments


def _own_prep(prep: Preprocessor, train: DataFrame) -> Preprocessor:
    """The same preparation fitted on a training fold alone."""
    return Preprocessor(
        prep.numeric, prep.categorical, prep.scaling, prep.encode, prep.threshold, prep.order_by
    ).fit(train)


def _each(spark, job, items) -> list:
    with ThreadPoolExecutor(CONCURRENT_FITS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))


#: Categories of all columns up to which their indicators enter the sums of products.
INDICATORS = 128


def _ridge_fold_trials(
    df: DataFrame, spec: TableSpec, prep: Preprocessor, family: ModelFamily, trials: Sequence[dict],
    metric: Metric, folds: int, repeats: int, seed: int, fit_on_all: bool,
) -> list[tuple]:
    """With categories, whose codes and routes come from each training fold alone.

    Products of the numbers and of an indicator for each category are summed per bucket in one
    pass; another finds where each category first appears in each bucket. A fold's ordinal code or
    one-hot columns are a linear map of the indicators, so all folds follow from these sums.
    More than ``INDICATORS`` categories cost passes of their own for each fold.
    """
    seen = _first_places(df, prep)
    if seen is None:
        return _ridge_fold_scans(df, spec, prep, family, trials, metric, folds, repeats, seed)
    labels = sorted({(c, k) for _, c, k in seen}, key=lambda x: (x[0], x[1] is None, x[1] or ""))
    d = len(prep.numeric)
    names = [f"_x{i}" for i in range(d + len(labels))]
    shown = [col(c).alias(n) for c, n in zip(prep.numeric, names)]
    shown += [col(c).cast("string").eqNullSafe(F.lit(k)).cast("double").alias(n) for (c, k), n in zip(labels, names[d:])]
    wide = df.select(*shown, col(spec.target).alias("_y"), "_bucket")
    moments = group_moments(wide, names, "_y", F.col("_bucket"))
    scaled = range(1, d + 1) if prep.scaling else ()
    rows = []
    for rep in range(repeats):
        folds_of = dealt_folds(folds, rep, seed)
        for f in range(folds):
            inside = [b for b in range(BUCKETS) if folds_of[b] != f]
            own = _fold_map(seen, labels, prep, set(inside), d)
            train = own.T @ moments.total(inside) @ own
            test = own.T @ moments.total([b for b in range(BUCKETS) if folds_of[b] == f]) @ own
            picks = range(1, own.shape[1] - 1)
            rows += [
                _as_row(at, p, rep, f, scores_from_moments(train, test, picks, p["alpha"], scaled)[metric.name])
                for at, p in enumerate(trials)
            ]
    return sorted(rows, key=lambda r: (r[0], r[2], r[3]))


def _first_places(df: DataFrame, prep: Preprocessor) -> dict[tuple, tuple] | None:
    """The smallest order key of each category in each bucket, by (bucket, column, category)."""
    cells = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("category")) for c in prep.categorical]
    key = F.struct(*[col(c) for c in prep.order_by]) if prep.order_by else F.struct(F.lit(0))
    found = (
        df.select("_bucket", key.alias("seen"), F.explode(F.array(*cells)).alias("cell"))
        .groupBy("_bucket", "cell.column", "cell.category").agg(F.min("seen").alias("seen"))
    )
    rows = small_rows(found, BUCKETS * INDICATORS)
    if rows is None or len({(r["column"], r["category"]) for r in rows}) > INDICATORS:
        return None
    return {(r["_bucket"], r["column"], r["category"]): tuple(r["seen"]) for r in rows}


def _fold_map(seen: dict[tuple, tuple], labels: list[tuple], prep: Preprocessor, train: set[int], d: int) -> np.ndarray:
    """What turns [1, numbers, indicators, target] into a training fold's own columns.

    Codes are those of ``OrdinalEncoder``: from 1 by first appearance, -1 and -2 for a category
    and a missing value that the training rows do not have. Constants are left to the intercept.
    """
    first: dict[tuple, tuple] = {}
    for (b, c, k), key in seen.items():
        if b in train:
            first[c, k] = min(key, first.get((c, k), key))
    columns = []
    for c in prep.categorical:
        own = [k for column, k in labels if column == c]
        met = sorted((k for k in own if (c, k) in first), key=lambda k: (first[c, k], k is None, (k or "").encode()))
        at = {k: d + 1 + labels.index((c, k)) for k in own}
        if len([k for k in met if k is not None]) > prep.threshold:
            code = {k: i for i, k in enumerate(met, 1)}
            columns.append({at[k]: float(code.get(k, MISSING if k is None else UNSEEN)) for k in own})
        else:
            columns += [{at[k]: 1.0} for k in met]
    size = 2 + d + len(labels)
    out = np.zeros((size, 2 + d + len(columns)))
    out[np.arange(d + 1), np.arange(d + 1)] = 1.0
    for j, cells in enumerate(columns, d + 1):
        for i, value in cells.items():
            out[i, j] = value
    out[-1, -1] = 1.0
    return out


def _ridge_fold_scans(
    df: DataFrame, spec: TableSpec, prep: Preprocessor, family: ModelFamily, trials: Sequence[dict],
    metric: Metric, folds: int, repeats: int, seed: int,
) -> list[tuple]:
    """A fold costs the fit of its preparation and one pass of sums; the penalties are scored from these."""
    with staged(df, "tune") as table:

        def one(job: tuple[int, int]) -> list[tuple]:
            rep, f = job
            held = repeat_fold(F.col("_bucket"), folds, rep, seed) == f
            own = _own_prep(prep, table.filter(~held))
            coded = own.transform(table, [spec.target, "_bucket"])
            xs = [c for c in coded.columns if c not in (spec.target, "_bucket")]
            sums = group_moments(coded, xs, spec.target, held.cast("int"))
            train, test = sums.total([0]), sums.total([1])
            picks = range(1, len(xs) + 1)
            return [
                _as_row(at, p, rep, f, scores_from_moments(train, test, picks, p["alpha"])[metric.name])
                for at, p in enumerate(trials)
            ]

        jobs = [(rep, f) for rep in range(repeats) for f in range(folds)]
        return sorted((r for part in _each(df.sparkSession, one, jobs) for r in part), key=lambda r: (r[0], r[2], r[3]))


def _model_trials(
    df: DataFrame, spec: TableSpec, prep: Preprocessor, family: ModelFamily, trials: Sequence[dict],
    metric: Metric, folds: int, repeats: int, seed: int, fit_on_all: bool,
) -> list[tuple]:
    """Each trial costs its fits and one job that scores all its folds."""
    classes = class_labels(df, spec.target) if family.classifier else None
    sizes = {r["_bucket"]: r["count"] for r in df.groupBy("_bucket").count().collect()}
    total = sum(sizes.values())

    with staged(in_place(dealt(df, total, seed), total), "tune") as table:
        place = ["_block", "_place"]

        def split(job: tuple[int, int]) -> tuple:
            rep, f = job
            fold = repeat_fold(F.col("_bucket"), folds, rep, seed)
            train, test = table.filter(fold != f), table.filter(fold == f)
            own = prep if fit_on_all else _own_prep(prep, train)
            a, b = own.transform(train, [spec.target, *place]), own.transform(test, [spec.target])
            folds_of = dealt_folds(folds, rep, seed)
            n = sum(count for at, count in sizes.items() if folds_of[at] != f)
            return a, b, [c for c in b.columns if c != spec.target], n

        jobs = [(rep, f) for rep in range(repeats) for f in range(folds)]
        splits = dict(zip(jobs, _each(df.sparkSession, split, jobs)))

        def fit(job: tuple[int, int, int]) -> DataFrame:
            at, rep, f = job
            train, test, xs, n = splits[rep, f]
            fitted = fit_model(train, xs, spec.target, family, trials[at], seed, classes, n)
            return fitted.predict(test).select(
                spec.target, "prediction", F.lit(rep).alias("_rep"), F.lit(f).alias("_fold")
            )

        def scored(at: int) -> list[tuple]:
            parts = _each(df.sparkSession, fit, [(at, *job) for job in jobs])
            tested = functools.reduce(DataFrame.unionByName, parts)
            found = {
                (r["_rep"], r["_fold"]): r["score"]
                for r in score(tested, spec.target, "prediction", metric, ["_rep", "_fold"]).collect()
            }
            return [_as_row(at, trials[at], rep, f, found.get((rep, f))) for rep, f in jobs]

        return [row for at in range(len(trials)) for row in scored(at)]


def _cell_trials(
    df: DataFrame, spec: TableSpec, prep: Preprocessor, family: ModelFamily, trials: Sequence[dict],
    metric: Metric, folds: int, repeats: int, seed: int, fit_on_all: bool,
) -> list[tuple] | None:
    """Trees of all trials and folds from the number of equal rows in each bucket.

    One scan counts them; None if too many differ, or for other families. A fold's scores
    follow from the same counts. The bins of ``leaf_reg`` and ``leaf_clf`` are cut over all rows, those of
    the others over the training fold.
    """
    params = [{**family.defaults, **p} for p in trials]
    built = [_trees_of(family, p, seed) for p in params]
    if not can_score(metric) or any(b is None for b in built):
        return None
    classes = class_labels(df, spec.target) if family.classifier else None
    coded = prep.transform(df, [spec.target, "_bucket"])
    xs = [c for c in coded.columns if c not in (spec.target, "_bucket")]
    label = label_index(spec.target, classes) if classes is not None else number(spec.target)
    table = equal_rows(viewed(coded, xs, label, F.col("_bucket")))
    if table is None:
        return None
    leaves, n_classes = isinstance(built[0], LeafBoost), len(classes or ())
    whole = cells_of(table, BINS) if leaves else None
    groups = table["g"].to_numpy()
    rows = {}
    for rep in range(repeats):
        for f in range(folds):
            inside = np.isin(groups, list(_training(rep, f, folds, seed)))
            if leaves:
                held = np.isin(whole.group, list(_training(rep, f, folds, seed)))
                train, test = (ungrouped(whole.of(np.flatnonzero(k))) for k in (held, ~held))
            else:
                train = ungrouped(cells_of(table.filter(pa.array(inside)), DEPTH_BINS))
                test = ungrouped(cells_of(table.filter(pa.array(~inside)), DEPTH_BINS, train.cuts))
            for at, estimator in enumerate(built):
                if leaves:
                    model = boost_cells(train, Booster(params[at], seed, train.cuts, n_classes))
                else:
                    model = estimator.grow(train, n_classes, df.sparkSession)
                value = score_cells(test, model.predicted(test.bins), metric)
                rows[at, rep, f] = _as_row(at, trials[at], rep, f, value)
    return [rows[key] for key in sorted(rows)]


def _trees_of(family: ModelFamily, params: dict, seed: int) -> LeafBoost | CellTrees | None:
    """What grows the family's trees from cells, if the family is one of the library's."""
    if FAMILIES.get(family.name) is not family:
        return None
    if family.name in ("tree_reg", "tree_clf"):
        return CellTrees("tree", params, seed, None)
    built = family.build(params, 1, seed)
    return built if isinstance(built, (LeafBoost, CellTrees)) else None


def _boost_trials(
    df: DataFrame, spec: TableSpec, prep: Preprocessor, family: ModelFamily, trials: Sequence[dict],
    metric: Metric, folds: int, repeats: int, seed: int, fit_on_all: bool,
) -> list[tuple]:
    """Trees of many trials and folds from the same scans of one binned table.

    Trees do not see a fold's scaling, so the rows are prepared once. The bins' cuts
    come from all rows, without their target.
    """
    classes = class_labels(df, spec.target) if family.classifier else None
    coded = prep.transform(df, [spec.target, "_bucket"])
    xs = [c for c in coded.columns if c not in (spec.target, "_bucket")]
    params = [{**family.defaults, **p} for p in trials]
    n_rows, place = coded.count(), F.lit(0)
    cuts = bin_cuts(coded.select(*[col(x) for x in xs]), xs, n_rows, BINS)
    if any(p["subsample"] < 1.0 for p in params):
        coded, place = dealt(coded, n_rows, seed), F.col("_place")
    label = label_index(spec.target, classes) if classes is not None else number(spec.target)
    jobs = [(at, rep, f) for at in range(len(trials)) for rep in range(repeats) for f in range(folds)]
    outputs = len(classes) if classes is not None and len(classes) > 2 else 1
    step, rows = max(1, SIDE_BY_SIDE // outputs), []
    binned = spread_out(binned_rows(coded, xs, label, F.col("_bucket"), place, cuts), n_rows)
    with staged(binned, "tune") as table:
        for first in range(0, len(jobs), step):
            part = jobs[first : first + step]
            models = [
                Booster(params[at], seed, cuts, len(classes or ()), _training(rep, f, folds, seed)) for at, rep, f in part
            ]
            tested = held_out(table, boost(table, models))
            if classes is not None:
                tested = tested.withColumns({c: class_of(F.col(c), classes) for c in ("y", "prediction")})
            found = {r["model"]: r["score"] for r in score(tested, "y", "prediction", metric, ["model"]).collect()}
            rows += [_as_row(at, trials[at], rep, f, found.get(i)) for i, (at, rep, f) in enumerate(part)]
    return rows


def _training(rep: int, f: int, folds: int, seed: int) -> frozenset[int]:
    folds_of = dealt_folds(folds, rep, seed)
    return frozenset(b for b in range(BUCKETS) if folds_of[b] != f)
