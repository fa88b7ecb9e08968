"""Repeatable folds and holdouts, as functions of key columns (K1-K3)."""

from __future__ import annotations

import functools
import random
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_list, col, not_nan, require
from .quantiles import GATHER_ROWS, values_at_ranks

_HASH_SPAN = 2**62
# Divisible by the usual fold counts, so each fold gets the same share.
BUCKETS = 240


def _hash(df: DataFrame, key: Sequence[str], *salts) -> Column:
    """Non-negative hash of the key; without a key, of the whole row.

    The key should identify a row: rows that share it share a fold.
    """
    cols = require(df, key) or df.columns
    return F.pmod(F.xxhash64(*[col(c) for c in cols], *salts), F.lit(_HASH_SPAN))


def kfold(
    df: DataFrame,
    key: str | Sequence[str] = (),
    k: int = 5,
    shuffle: bool = False,
    seed: int = 0,
    name: str = "fold",
    n_rows: int | None = None,
) -> DataFrame:
    """Add a fold number 0..k-1.

    Unshuffled folds are contiguous runs of the key order, missing keys first,
    and the first ``n mod k`` of them hold one row more. Only the k-1 boundary
    keys are looked up; no row moves. Shuffled folds hash the key, of any type,
    or the whole row without one. ``n_rows``, if known, saves a count.
    """
    key = as_list(key)
    if shuffle:
        fold = F.pmod(_hash(df, key, F.lit(seed)), F.lit(k)).cast("int")
        return df.withColumn(name, fold)
    if not key:
        raise ValueError("contiguous folds need key columns that order the rows")
    values = [_orderable(df, c) for c in require(df, key)]
    counted = df.agg(F.count(F.lit(1)), *[F.count(v) for v in values]).first()
    n = counted[0] if n_rows is None else n_rows
    ordered = []
    for value, present in zip(values, counted[1:]):
        if present < counted[0]:
            ordered += [value.isNotNull().cast("int"), F.coalesce(value, F.lit(0))]
        else:
            ordered.append(value)
    if n < k:
        raise ValueError(f"{n} rows cannot fill {k} folds")
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    starts = list(accumulate(sizes))[:-1]
    frame = df.select(*[o.alias(f"k{i}") for i, o in enumerate(ordered)])
    lookup = sorted({r for s in starts for r in (s - 1, s)})
    keys = dict(zip(lookup, _keys_at(frame, lookup, n)))
    for s in starts:
        if keys[s - 1] == keys[s]:
            raise ValueError(f"key {key} does not order the rows at a fold boundary")
    fold = functools.reduce(
        lambda a, b: a + b, [_at_least(ordered, keys[s]).cast("int") for s in starts], F.lit(0)
    )
    return df.withColumn(name, fold)


def _orderable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col(name))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return not_nan(col(name).cast("double"))
    if isinstance(kind, T.NumericType):
        return col(name)
    raise TypeError(f"order key {name} must be numeric, date or timestamp; hash folds take any key")


def has_order(df: DataFrame, key: Sequence[str]) -> bool:
    """Whether contiguous folds can follow the key columns."""
    kinds = (T.NumericType, T.DateType, T.TimestampType)
    return bool(key) and all(isinstance(df.schema[c].dataType, kinds) for c in key)


def _at_least(key: Sequence[Column], bound: Sequence) -> Column:
    """Lexicographic ``key >= bound`` as plain comparisons."""
    test = key[-1] >= F.lit(bound[-1])
    for c, b in zip(reversed(key[:-1]), reversed(bound[:-1])):
        test = (c > F.lit(b)) | ((c == F.lit(b)) & test)
    return test


def _keys_at(frame: DataFrame, ranks: Sequence[int], n_rows: int | None = None) -> list[tuple]:
    """Key tuples at 0-based ranks of the key order.

    The first column is searched by rank; rows tied there are few, unless the
    value is hot, in which case the next column is searched the same way.
    """
    first, *rest = frame.columns
    hits = values_at_ranks(frame, [(first, r) for r in ranks], n_rows)
    if not rest:
        return [(h.value,) for h in hits]
    found: dict[int, tuple] = {}
    ties = frame.filter(col(first).isin(sorted({h.value for h in hits})))
    rows = ties.limit(GATHER_ROWS + 1).collect()
    for value in sorted({h.value for h in hits}):
        wanted = [(r, r - h.below) for r, h in zip(ranks, hits) if h.value == value]
        if len(rows) <= GATHER_ROWS:
            same = sorted(tuple(row) for row in rows if row[0] == value)
            found.update({r: same[i] for r, i in wanted})
        else:
            inner = frame.filter(col(first) == F.lit(value)).select(*rest)
            tails = _keys_at(inner, [i for _, i in wanted])
            found.update({r: (value, *t) for (r, _), t in zip(wanted, tails)})
    return [found[r] for r in ranks]


def holdouts(
    df: DataFrame, key: str | Sequence[str] = (), n: int = 30, test: float = 0.3, seed: int = 0
) -> DataFrame:
    """Every row once per repeat, marked test with probability ``test``.

    Adds ``rep`` and boolean ``is_test``. The number of rows grows n-fold, so
    this suits the small tables it is meant for.
    """
    rep = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    out = df.withColumn("rep", rep)
    keys = as_list(key) or df.columns
    limit = int(test * _HASH_SPAN)
    return out.withColumn("is_test", _hash(out, keys, F.lit(seed), col("rep")) < F.lit(limit))


def bucket(df: DataFrame, key: str | Sequence[str] = (), seed: int = 0) -> Column:
    """Random but repeatable group of a row, the unit the repeated folds deal out."""
    return F.pmod(_hash(df, as_list(key), F.lit(seed)), F.lit(BUCKETS)).cast("int")


def dealt_folds(k: int, rep: int, seed: int = 0) -> list[int]:
    """Fold of each bucket in one repeat: a seeded shuffle dealt round robin."""
    order = list(range(BUCKETS))
    random.Random(f"{seed}/{rep}").shuffle(order)
    folds = [0] * BUCKETS
    for place, b in enumerate(order):
        folds[b] = place % k
    return folds


def repeat_fold(in_bucket: Column, k: int, rep: int, seed: int = 0) -> Column:
    """Fold of a row in one repeat, given its bucket; no row is multiplied."""
    table = F.array(*[F.lit(f) for f in dealt_folds(k, rep, seed)])
    return F.element_at(table, in_bucket + 1)


def repeated_kfold(
    df: DataFrame,
    key: str | Sequence[str] = (),
    k: int = 3,
    repeats: int = 10,
    seed: int = 0,
) -> DataFrame:
    """Every row once per repeat with ``rep`` and the fold it is tested in.

    Models that need no row per repeat use ``bucket`` and ``repeat_fold``; the
    folds are the same.
    """
    folds = F.array(*[repeat_fold(F.col("_bucket"), k, r, seed) for r in range(repeats)])
    return (
        df.withColumn("_bucket", bucket(df, key, seed))
        .select(*[col(c) for c in df.columns], F.posexplode(folds).alias("rep", "fold"))
    )


def fold_sizes(df: DataFrame, by: Sequence[str] = ("fold",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
