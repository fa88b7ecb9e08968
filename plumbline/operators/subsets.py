"""Two-objective subset search: fewest features, best score.

Scoring is the Spark work. Ridge masks are scored from fold sums of products,
gathered in one pass over the data; trees of all masks and folds grow together from
shared histograms; forests are fitted by Spark ML, each distinct mask once. The evolution handles a few hundred 0/1 masks on the driver.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, number
from ..spec import TableSpec
from ..staging import staged
from .binned import Binned, bin_cuts, bin_rows, tree_scores
from .encoding import encode_categories
from .gram import column_means, group_moments, scores_from_moments
from .metrics import score
from .models import ModelFamily, class_labels, dealt, family_named, fit_model, in_place, label_index
from .splits import has_order, holdouts, kfold

Mask = tuple[int, ...]
Scorer = Callable[[Sequence[Mask]], dict[Mask, float]]

# Table size that separates folds from holdouts, and their counts.
FOLD_ROWS = 1000
FOLDS = 5
HOLDOUTS = 30
DISQUALIFIED = (float("inf"), 0.0)
CONCURRENT_FITS = 4


def split_groups(
    df: DataFrame, key: Sequence[str], seed: int = 0, split: str | None = None
) -> tuple[DataFrame, list[tuple[list[int], list[int]]]]:
    """Rows with an integer ``_group`` and (train groups, test groups) per split.

    ``split`` is "folds" (five) or "holdouts" (thirty random ones, one copy of the
    table per repeat); None takes folds from 1000 rows on. Folds are contiguous
    where the key columns order the rows, else by a hash of the key, or of the
    whole row without one.
    """
    if split not in (None, "folds", "holdouts"):
        raise ValueError("split is folds, holdouts or None")
    n_rows = df.count()
    if split == "folds" or (split is None and n_rows >= FOLD_ROWS):
        folds = list(range(FOLDS))
        placed = kfold(
            df, key, FOLDS, shuffle=not has_order(df, key), seed=seed, name="_group", n_rows=n_rows
        )
        return placed, [([g for g in folds if g != f], [f]) for f in folds]
    held = holdouts(df, key, HOLDOUTS, 0.3, seed)
    grouped = held.withColumn("_group", F.col("rep") * 2 + F.col("is_test").cast("int")).drop("rep", "is_test")
    return grouped, [([2 * r], [2 * r + 1]) for r in range(HOLDOUTS)]


def ridge_scorer(
    df: DataFrame,
    spec: TableSpec,
    features: Sequence[str],
    alpha: float = 1.0,
    seed: int = 0,
    split: str | None = None,
) -> Scorer:
    """Mean r2 over the splits; the data is read once, here."""
    grouped, splits = split_groups(df, spec.key, seed, split)
    moments = group_moments(grouped, features, spec.target, F.col("_group"))
    parts = [(moments.total(train), moments.total(test)) for train, test in splits]

    def scorer(masks: Sequence[Mask]) -> dict[Mask, float]:
        out = {}
        for mask in masks:
            picks = [i + 1 for i, keep in enumerate(mask) if keep]
            found = [scores_from_moments(a, b, picks, alpha)["r2"] for a, b in parts]
            known = [v for v in found if v is not None]
            out[mask] = sum(known) / len(known) if known else 0.0
        return out

    return scorer


@contextmanager
def model_scorer(
    df: DataFrame,
    spec: TableSpec,
    features: Sequence[str],
    family: str | ModelFamily,
    params: dict | None = None,
    seed: int = 0,
    split: str | None = None,
) -> Iterator[Scorer]:
    """Mean score over the splits with Spark ML models, a few fits at a time.

    The coded columns are written once, in dealt order, for the time of the
    block. A mask costs its fits and one job that scores all its splits.
    """
    family = family_named(family)
    metric = "accuracy" if family.classifier else "r2"
    grouped, splits = split_groups(df, spec.key, seed, split)
    label = col(spec.target) if family.classifier else number(spec.target).alias(spec.target)
    columns = grouped.select(*[number(f).alias(f) for f in features], label, F.col("_group"))
    column_means(columns, features)
    sizes = {r["_group"]: r["count"] for r in columns.groupBy("_group").count().collect()}
    total = sum(sizes.values())
    classes = class_labels(columns, spec.target) if family.classifier else None
    spark = df.sparkSession

    with staged(in_place(dealt(columns, total, seed), total), "subset") as table:

        def one(mask: Mask) -> tuple[Mask, float]:
            xs = [f for f, keep in zip(features, mask) if keep]
            tested = None
            for at, (train, test) in enumerate(splits):
                n = sum(sizes.get(g, 0) for g in train)
                if not n or not any(sizes.get(g) for g in test):
                    continue
                fitted = fit_model(
                    table.filter(F.col("_group").isin(train)), xs, spec.target, family, params, seed, classes, n
                )
                part = fitted.predict(table.filter(F.col("_group").isin(test)))
                part = part.select(spec.target, "prediction", F.lit(at).alias("_split"))
                tested = part if tested is None else tested.unionByName(part)
            if tested is None:
                return mask, 0.0
            rows = score(tested, spec.target, "prediction", metric, ["_split"]).collect()
            known = [r["score"] for r in rows if r["score"] is not None]
            return mask, sum(known) / len(known) if known else 0.0

        def scorer(masks: Sequence[Mask]) -> dict[Mask, float]:
            with ThreadPoolExecutor(CONCURRENT_FITS) as pool:
                return dict(pool.map(inheritable_thread_target(spark)(one), masks))

        yield scorer


@contextmanager
def tree_scorer(
    df: DataFrame,
    spec: TableSpec,
    features: Sequence[str],
    classifier: bool,
    max_depth: int = 5,
    seed: int = 0,
    split: str | None = None,
) -> Iterator[Scorer]:
    """Mean accuracy or r2 of decision trees, all masks and splits in one scan per level.

    The columns are binned and written once. A call costs at most ``max_depth`` scans, however
    many masks it scores; nodes that an earlier call met cost none.
    """
    grouped, splits = split_groups(df, spec.key, seed, split)
    label = col(spec.target) if classifier else number(spec.target)
    columns = grouped.select(
        *[number(f).alias(f) for f in features], label.alias(spec.target), F.col("_group")
    )
    if classifier:
        column_means(columns, features)
        classes = class_labels(columns, spec.target)
        target, shift = label_index(spec.target, classes), 0.0
    else:
        classes, shift = [], float(column_means(columns, [*features, spec.target])[-1])
        target = col(spec.target) - F.lit(shift)
    columns = columns.filter(target.isNotNull())
    per_group = columns.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), F.sum(target * target).alias("s")).collect()
    n_groups = 1 + max(r["_group"] for r in per_group)
    squares = np.zeros(n_groups)
    for r in per_group:
        squares[r["_group"]] = r["s"]
    n_rows = sum(r["n"] for r in per_group)
    cuts = bin_cuts(grouped, features, n_rows)
    with staged(bin_rows(columns, features, cuts, target, F.col("_group")), "bins") as rows:
        binned = Binned(rows, len(features), n_groups, len(classes))
        yield lambda masks: tree_scores(binned, masks, splits, squares, max_depth)


def _better(a: tuple[float, float], b: tuple[float, float]) -> bool:
    """a dominates b: no more features, no worse score, and one strictly so."""
    return a[0] <= b[0] and a[1] >= b[1] and a != b


def _fronts(fits: Sequence[tuple[float, float]]) -> list[list[int]]:
    """Indices by non-domination rank."""
    left = list(range(len(fits)))
    out = []
    while left:
        # Only the best score per feature count can survive, so sort and sweep.
        best, front = float("-inf"), []
        for i in sorted(left, key=lambda i: (fits[i][0], -fits[i][1])):
            tied = bool(front) and fits[i] == fits[front[-1]]
            if fits[i][1] > best or tied:
                front.append(i)
                best = max(best, fits[i][1])
        out.append(front)
        chosen = set(front)
        left = [i for i in left if i not in chosen]
    return out


def _crowding(front: Sequence[int], fits: Sequence[tuple[float, float]]) -> dict[int, float]:
    """Gap to the neighbours along each objective; the ends count as infinite."""
    gap = {i: 0.0 for i in front}
    for objective in (0, 1):
        order = sorted(front, key=lambda i: fits[i][objective])
        low, high = fits[order[0]][objective], fits[order[-1]][objective]
        gap[order[0]] = gap[order[-1]] = float("inf")
        if high > low and high != float("inf"):
            for before, i, after in zip(order, order[1:], order[2:]):
                gap[i] += (fits[after][objective] - fits[before][objective]) / (high - low)
    return gap


def keep_best(population: Sequence[Mask], fits: Sequence[tuple[float, float]], mu: int) -> list[Mask]:
    """The mu masks of lowest rank, the last rank cut by crowding distance."""
    kept: list[Mask] = []
    for front in _fronts(fits):
        gap = _crowding(front, fits)
        room = mu - len(kept)
        chosen = front if len(front) <= room else sorted(front, key=lambda i: -gap[i])[:room]
        kept += [population[i] for i in chosen]
        if len(kept) == mu:
            break
    return kept


def _child(population: Sequence[Mask], rng: random.Random, cxpb: float, flip: float) -> Mask:
    """Two-point crossover, first child kept, or independent bit flips."""
    if rng.random() < cxpb and len(population) > 1:
        a, b = rng.sample(population, 2)
        cuts = sorted((rng.randint(0, len(a)), rng.randint(0, len(a))))
        return a[: cuts[0]] + b[cuts[0] : cuts[1]] + a[cuts[1] :]
    return tuple(bit ^ (rng.random() < flip) for bit in rng.choice(population))


# Names of the models.
MODELS = {
    "ridge": "ridge", "DTC": "tree_clf", "DTR": "tree_reg", "RFC": "forest_clf", "RFR": "forest_reg"
}


def subset_search(
    df: DataFrame,
    spec: TableSpec,
    model: str = "ridge",
    max_features: int = 10,
    generations: int = 500,
    mu: int = 100,
    lam: int = 300,
    cxpb: float = 0.4,
    max_depth: int = 5,
    seed: int = 0,
    scorer: Scorer | None = None,
    split: str | None = None,
) -> DataFrame:
    """Front of feature subsets: (n, score, selected) by score, best first."""
    front, _ = subset_search_log(
        df, spec, model, max_features, generations, mu, lam, cxpb, max_depth, seed, scorer, split
    )
    return front


def subset_search_log(
    df: DataFrame,
    spec: TableSpec,
    model: str = "ridge",
    max_features: int = 10,
    generations: int = 500,
    mu: int = 100,
    lam: int = 300,
    cxpb: float = 0.4,
    max_depth: int = 5,
    seed: int = 0,
    scorer: Scorer | None = None,
    split: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The front, and a log of average, best and worst score per generation.

    Folds are fixed, so a mask's score never changes and is computed once.
    Empty masks and masks above ``max_features`` are disqualified. ``scorer``
    maps masks to scores and replaces the model's own. ``split`` is that of
    ``split_groups``.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; have {sorted(MODELS)}")
    features = spec.numerics(df) + spec.categories(df)
    options = (features, max_features, generations, mu, lam, cxpb, seed)
    if scorer is not None:
        return _evolve(df, scorer, *options)
    coded = encode_categories(df, spec)
    if model == "ridge":
        return _evolve(df, ridge_scorer(coded, spec, features, seed=seed, split=split), *options)
    if model.startswith("DT"):
        with tree_scorer(coded, spec, features, model == "DTC", max_depth, seed, split) as scorer:
            return _evolve(df, scorer, *options)
    with model_scorer(coded, spec, features, MODELS[model], {"max_depth": 5}, seed, split) as scorer:
        return _evolve(df, scorer, *options)


def _evolve(
    df: DataFrame, scorer: Scorer, features: Sequence[str], max_features: int, generations: int,
    mu: int, lam: int, cxpb: float, seed: int,
) -> tuple[DataFrame, DataFrame]:
    rng = random.Random(seed)
    rate = min(1.0, max_features / len(features))
    known: dict[Mask, tuple[float, float]] = {}

    def evaluate(masks: Sequence[Mask]) -> list[tuple[float, float]]:
        new = [m for m in dict.fromkeys(masks) if m not in known]
        known.update({m: DISQUALIFIED for m in new if not 0 < sum(m) <= max_features})
        todo = [m for m in new if m not in known]
        if todo:
            known.update({m: (float(sum(m)), float(s)) for m, s in scorer(todo).items()})
        return [known[m] for m in masks]

    population: list[Mask] = [tuple(int(rng.random() < rate) for _ in features) for _ in range(mu)]
    log = []
    for generation in range(generations + 1):
        population = population + [_child(population, rng, cxpb, rate) for _ in range(lam)]
        population = keep_best(population, evaluate(population), mu)
        scores = [known[m][1] for m in population]
        sizes = [sum(m) for m in population]
        log.append((generation, sum(scores) / len(scores), max(scores), min(scores), sum(sizes) / len(sizes), max(sizes), min(sizes)))
    fits = evaluate(population)
    best = {
        population[i]: fits[i] for i in _fronts(fits)[0] if fits[i] != DISQUALIFIED
    }
    rows = [
        (int(n), s, [f for f, keep in zip(features, mask) if keep])
        for mask, (n, s) in sorted(best.items(), key=lambda item: (-item[1][1], item[1][0], item[0]))
    ]
    spark = df.sparkSession
    return (
        spark.createDataFrame(rows, "n int, score double, selected array<string>"),
        spark.createDataFrame(
            log,
            "generation int, avg_score double, max_score double, min_score double, "
            "avg_n double, max_n int, min_n int",
        ),
    )
