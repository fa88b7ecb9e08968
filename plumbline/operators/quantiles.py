"""Exact order statistics without a global sort (base of T1, A11, K1).

The value at a rank is found by narrowing: a sketch brackets it, counting passes
shrink the bracket, and only a bracket of at most ``GATHER_ROWS`` rows is ever
sorted in one place. Each pass is a scan of the needed columns with map-side
combined counts.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, number, require

GATHER_ROWS = 20_000
BINS = 2048
SKETCH_ACCURACY = 10_000


@dataclass
class _Bracket:
    """A range of one column known to hold the value at a rank."""

    column: int
    rank: int
    lo: object
    hi: object
    below: int = 0
    inside: int = 0

    @property
    def solved(self) -> bool:
        return self.lo == self.hi

    def has_rank(self) -> bool:
        return self.below <= self.rank < self.below + self.inside


@dataclass(frozen=True)
class RankValue:
    value: object
    below: int  # rows strictly smaller


def values_at_ranks(
    df: DataFrame, targets: Sequence[tuple[str, int]], n_rows: int | None = None
) -> list[RankValue]:
    """Value at each (column, 0-based rank) among the non-missing values.

    ``n_rows`` saves a pass: it turns ranks into the shares the sketch needs.
    """
    names = list(dict.fromkeys(c for c, _ in targets))
    nums = df.select(*[col(c).alias(f"v{i}") for i, c in enumerate(names)])
    n_rows = df.count() if n_rows is None else n_rows
    wanted = [_Target(names.index(c), r, min(1.0, r / max(1, n_rows))) for c, r in targets]
    return _search(nums, _survey(nums, wanted)[0], wanted)


@dataclass(frozen=True)
class _Target:
    column: int
    rank: int
    share: float  # of the column's values, where the sketch looks


@dataclass(frozen=True)
class _Survey:
    """First look at a column: counts, finite ends, sketched points."""

    n: int
    low: int
    high: int
    first: object
    last: object
    around: dict[float, tuple]  # share -> sketched values a little before and after


def _survey(
    nums: DataFrame, targets: Sequence[_Target], also: Sequence[Column] = ()
) -> tuple[list[_Survey], Row]:
    """One pass over all columns, each sketched a little around every share.

    ``also`` are further aggregates of the same columns; the row has them.
    """
    slack = 2.0 / SKETCH_ACCURACY
    aggregates, shares = [], []
    for i in range(len(nums.columns)):
        shares.append(sorted({t.share for t in targets if t.column == i}))
        around = [min(1.0, max(0.0, s + d)) for s in shares[i] for d in (-slack, slack)]
        aggregates += _extent(nums, f"v{i}", i)
        aggregates.append(F.percentile_approx(f"v{i}", around, SKETCH_ACCURACY).alias(f"p{i}"))
    row = nums.agg(*aggregates, *also).first()
    out = []
    for i in range(len(nums.columns)):
        points = row[f"p{i}"] or [None] * (2 * len(shares[i]))
        pairs = dict(zip(shares[i], zip(points[::2], points[1::2])))
        out.append(_Survey(*(row[f"{name}{i}"] for name in ("n", "low", "high", "a", "b")), pairs))
    return out, row


def _search(
    nums: DataFrame, surveys: Sequence[_Survey], targets: Sequence[_Target]
) -> list[RankValue]:
    brackets = []
    for t in targets:
        i, rank, s = t.column, t.rank, surveys[t.column]
        if not 0 <= rank < s.n:
            raise ValueError(f"rank {rank} is outside the {s.n} values")
        if rank < s.low:
            brackets.append(_Bracket(i, rank, -math.inf, -math.inf, 0, s.low))
        elif rank >= s.n - s.high:
            brackets.append(_Bracket(i, rank, math.inf, math.inf, s.n - s.high, s.high))
        else:
            brackets.append(_Bracket(i, rank, s.first, s.last, s.low, s.n - s.low - s.high))
    _tighten(nums, brackets, [surveys[t.column].around[t.share] for t in targets])
    while any(not b.solved and b.inside > GATHER_ROWS for b in brackets):
        _narrow(nums, [b for b in brackets if not b.solved and b.inside > GATHER_ROWS])
    return _gather(nums, brackets)


def _extent(nums: DataFrame, name: str, i: int) -> list[Column]:
    """Count, ends of the finite values, and how many are infinite."""
    value, finite, low, high = F.col(name), F.col(name), F.lit(0), F.lit(0)
    if isinstance(nums.schema[name].dataType, (T.FloatType, T.DoubleType)):
        low, high = F.count_if(value == -math.inf), F.count_if(value == math.inf)
        finite = F.when(F.abs(value) != math.inf, value)
    return [
        F.count(value).alias(f"n{i}"),
        F.min(finite).alias(f"a{i}"),
        F.max(finite).alias(f"b{i}"),
        low.alias(f"low{i}"),
        high.alias(f"high{i}"),
    ]


def _tighten(nums: DataFrame, brackets: list[_Bracket], guesses: Sequence[tuple]) -> None:
    """Shrink wide brackets to the sketched values, where counting confirms them."""
    wide = [(b, g) for b, g in zip(brackets, guesses) if not b.solved and b.inside > GATHER_ROWS]
    if not wide:
        return
    trial = [_Bracket(b.column, b.rank, max(g[0], b.lo), min(g[1], b.hi)) for b, g in wide]
    seen = nums.agg(
        *[
            F.count_if(condition).alias(f"{name}{k}")
            for k, t in enumerate(trial)
            for name, condition in (
                ("below", F.col(f"v{t.column}") < F.lit(t.lo)),
                ("inside", F.col(f"v{t.column}").between(t.lo, t.hi)),
            )
        ]
    ).first()
    for (b, _), (k, t) in zip(wide, enumerate(trial)):
        t.below, t.inside = seen[f"below{k}"], seen[f"inside{k}"]
        if t.has_rank():
            b.lo, b.hi, b.below, b.inside = t.lo, t.hi, t.below, t.inside


def _tagged(nums: DataFrame, brackets: list[_Bracket], *extra) -> DataFrame:
    """One row (k, v, ...) per bracket that holds the value; others vanish."""
    hits = F.array(
        *[
            F.when(
                F.col(f"v{b.column}").between(b.lo, b.hi),
                F.struct(F.lit(k).alias("k"), *[e(F.col(f"v{b.column}"), b) for e in extra]),
            )
            for k, b in enumerate(brackets)
        ]
    )
    inside = functools.reduce(
        lambda a, b: a | b, [F.col(f"v{b.column}").between(b.lo, b.hi) for b in brackets]
    )
    tagged = nums.filter(inside).select(F.explode(hits).alias("h"))
    return tagged.filter(F.col("h").isNotNull()).select("h.*")


def _position(value: Column, b: _Bracket) -> Column:
    # Whole numbers are subtracted as such: far from zero doubles would merge them.
    share = (value - F.lit(b.lo)).cast("double") / F.lit(float(b.hi - b.lo))
    return F.least(F.floor(share * F.lit(float(BINS))).cast("int"), F.lit(BINS - 1)).alias("bin")


def _narrow(nums: DataFrame, brackets: list[_Bracket]) -> None:
    """Replace each bracket by the extent of the one bin that holds its rank.

    At most BINS rows per bracket come back. Ends are values that occur and fall
    into different bins, so every pass drops at least one of them, and a hot
    value ends up alone in its bracket.
    """
    counted = (
        _tagged_by_type(nums, brackets, lambda v, b: _position(v, b), lambda v, b: v.alias("v"))
        .groupBy("k", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    for k, b in enumerate(brackets):
        bins = sorted((r["bin"], r) for r in counted if r["k"] == k)
        if len(bins) < 2:
            raise ValueError(f"cannot separate values between {b.lo} and {b.hi}")
        below = b.below
        for _, r in bins:
            if b.rank < below + r["n"]:
                b.lo, b.hi, b.below, b.inside = r["lo"], r["hi"], below, r["n"]
                break
            below += r["n"]


def _tagged_by_type(nums: DataFrame, brackets: list[_Bracket], *extra) -> DataFrame:
    """``_tagged`` with the value widened to one type when columns differ."""
    types = {nums.schema[f"v{b.column}"].dataType.simpleString() for b in brackets}
    if len(types) > 1:
        nums = nums.select(*[F.col(c).cast("double").alias(c) for c in nums.columns])
    return _tagged(nums, brackets, *extra)


def _gather(nums: DataFrame, brackets: list[_Bracket]) -> list[RankValue]:
    if open_ones := [b for b in brackets if not b.solved]:
        found = (
            _tagged_by_type(nums, open_ones, lambda v, b: v.alias("v"))
            .groupBy("k")
            .agg(F.sort_array(F.collect_list("v")).alias("vs"))
            .select(
                "k",
                F.element_at(F.col("vs"), _pick(open_ones)).alias("v"),
                F.array_position(F.col("vs"), F.element_at(F.col("vs"), _pick(open_ones))).alias("at"),
            )
            .collect()
        )
        for r in found:
            b = open_ones[r["k"]]
            b.lo = b.hi = r["v"]
            b.below += r["at"] - 1
    return [RankValue(b.lo, b.below) for b in brackets]


def _pick(brackets: list[_Bracket]) -> Column:
    """1-based place of each bracket's rank inside its sorted values."""
    return F.element_at(
        F.array(*[F.lit(b.rank - b.below + 1) for b in brackets]), F.col("k") + 1
    )


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], approx: bool = False
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, missing values left out.

    ``approx`` answers from one sketch pass instead.
    """
    return quantiles_and(df, cols, probs, approx)[0]


def quantiles_and(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], approx: bool = False, also: Sequence[Column] = ()
) -> tuple[dict[str, list[float | None]], Row]:
    """The quantiles, and a row of further aggregates taken in the same first pass.

    ``also`` may use the columns as ``v0``, ``v1`` and so on.
    """
    cols = require(df, cols)
    nums = df.select(*[number(c).alias(f"v{i}") for i, c in enumerate(cols)])
    names = nums.columns
    if approx:
        sketches = [F.percentile_approx(v, list(probs), SKETCH_ACCURACY).alias(v) for v in names]
        row = nums.agg(*sketches, *also).first()
        return {c: list(row[v]) if row[v] else [None] * len(probs) for c, v in zip(cols, names)}, row
    surveys, first = _survey(nums, [_Target(i, 0, p) for i in range(len(names)) for p in probs], also)
    found: dict[str, list] = {v: [None] * len(probs) for v, s in zip(names, surveys) if not s.n}
    spots = {
        (i, p): p * (surveys[i].n - 1) for i, v in enumerate(names) if v not in found for p in probs
    }
    targets = [
        _Target(i, rank, p)
        for (i, p), spot in spots.items()
        for rank in dict.fromkeys((math.floor(spot), math.ceil(spot)))
    ]
    value = {(t.column, t.rank): r.value for t, r in zip(targets, _search(nums, surveys, targets))}
    for i, v in enumerate(names):
        if v not in found:
            found[v] = [_between(value, i, spots[i, p]) for p in probs]
    return {c: found[v] for c, v in zip(cols, names)}, first


def _between(value: dict, column: int, spot: float) -> float:
    """Linear interpolation between the two ranks around a spot."""
    low, high = value[column, math.floor(spot)], value[column, math.ceil(spot)]
    return low + (high - low) * (spot - math.floor(spot)) if high != low else low


def band(value: Column, q25: float | None, q75: float | None) -> Column:
    if q25 is None:
        return F.lit(None).cast("string")
    return (
        F.when(value >= q75, F.lit("q75"))
        .when(value >= q25, F.lit("q25-75"))
        .when(value < q25, F.lit("q25"))
    )


class QuantileBand:
    """Low / middle / high band of numeric columns at the quartiles."""

    def __init__(self, cols: str | Sequence[str], approx: bool = False):
        self.cols = [cols] if isinstance(cols, str) else list(cols)
        self.approx = approx
        self.cuts: dict[str, list[float | None]] = {}

    def fit(self, df: DataFrame) -> QuantileBand:
        self.cuts = exact_quantiles(df, self.cols, [0.25, 0.75], self.approx)
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: band(number(c), *self.cuts[c]) for c in require(df, self.cols)})


def quantile_band(df: DataFrame, cols: str | Sequence[str], approx: bool = False) -> DataFrame:
    return QuantileBand(cols, approx).fit(df).apply(df)
