"""Second-order terms of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame

from ..functions.columns import col, number, require


def interaction_terms(cols: Sequence[str]) -> list[Column]:
    """The columns, then ``a b`` for every pair in order."""
    firsts = [number(c).alias(c) for c in cols]
    return firsts + [(number(a) * number(b)).alias(f"{a} {b}") for a, b in combinations(cols, 2)]


def full_terms(cols: Sequence[str]) -> list[Column]:
    """The columns, then squares ``a^2`` and products ``a b`` in i <= j order."""
    firsts = [number(c).alias(c) for c in cols]
    return firsts + [
        (number(a) * number(b)).alias(f"{a}^2" if a == b else f"{a} {b}")
        for a, b in combinations_with_replacement(cols, 2)
    ]


def poly_interactions(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    cols = require(df, cols)
    return df.select(*[col(c) for c in require(df, keep)], *interaction_terms(cols))


def poly_full(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    cols = require(df, cols)
    return df.select(*[col(c) for c in require(df, keep)], *full_terms(cols))
