"""Projection, filters and the cleaning hook."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import as_list, col, nan_to_null, present, require
from ..spec import TableSpec

Featurizer = Callable[[DataFrame], DataFrame]
FEATURIZERS: dict[str, Featurizer] = {}


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*require(df, cols))


def drop_unlabeled(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is present; NaN counts as missing."""
    return present(df, require(df, [target]))


def dropna_keys(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    return present(df, require(df, as_list(keys)))


def assemble_columns(df: DataFrame, spec: TableSpec, numeric: Sequence | None = None) -> DataFrame:
    """Target, categories, then numerics (or the given numeric expressions)."""
    tail = [col(c) for c in spec.numerics(df)] if numeric is None else list(numeric)
    return df.select(
        *[col(c) for c in spec.key], col(spec.target), *[col(c) for c in spec.categories(df)], *tail
    )


def featurizer(func: Featurizer) -> Featurizer:
    """Register a table function; the first registration of a name wins."""
    FEATURIZERS.setdefault(func.__name__, func)
    return func


def apply_featurizers(df: DataFrame, featurizers: dict[str, Featurizer] | None = None) -> DataFrame:
    chain = FEATURIZERS if featurizers is None else featurizers
    return functools.reduce(lambda frame, func: frame.transform(func), chain.values(), df)


def select_features(df: DataFrame, cols_or_mask: Sequence, among: Sequence[str] | None = None) -> DataFrame:
    """Keep named columns, or those a 0/1 mask marks among the given names."""
    chosen = list(cols_or_mask)
    if chosen and not isinstance(chosen[0], str):
        names = list(among if among is not None else df.columns)
        if len(names) != len(chosen):
            raise ValueError("mask and column list differ in length")
        chosen = [name for name, keep in zip(names, chosen) if keep]
    return df.select(*[col(c) for c in require(df, chosen)])


def clean(
    df: DataFrame,
    casts: dict[str, str] | None = None,
    joins: Sequence[tuple[DataFrame, list[str]]] = (),
) -> DataFrame:
    """Repair types and join further tables.

    A value that does not fit its new type becomes null. Joins are left equi
    joins; Catalyst broadcasts a side only below its own size threshold.
    """
    casts = casts or {}
    require(df, casts)
    out = df.withColumns({c: col(c).try_cast(t) for c, t in casts.items()}) if casts else df
    for other, on in joins:
        out = out.join(other, as_list(on), "left")
    return nan_to_null(out)


def failed_casts(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """(column, failed): values present before the cast and null after it."""
    counts = df.agg(
        *[
            F.count(F.when(col(c).isNotNull() & col(c).try_cast(t).isNull(), F.lit(1))).alias(c)
            for c, t in casts.items()
        ]
    )
    return unpivot_one_row(counts, "column", "failed")


def unpivot_one_row(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.unpivot([], [col(c) for c in df.columns], name, value)


@dataclass
class StageAudit:
    """Row counts per stage, counted inside the one job that writes the result.

    ``watch`` tags a frame. Counts exist once an action over the last watched
    frame has run; ``table`` runs one itself if none has.
    """

    marks: list[tuple[str, list[str], Observation]] = field(default_factory=list)
    last: DataFrame | None = None

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        seen = Observation(f"{stage}-{len(self.marks)}")
        self.marks.append((stage, df.columns, seen))
        self.last = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
        return self.last

    def table(self, run: bool = True) -> DataFrame:
        if self.last is None:
            raise ValueError("no stage was watched")
        if run:
            self.last.write.format("noop").mode("overwrite").save()
        rows = [
            (stage, int(seen.get["n_rows"]), len(columns), ",".join(columns))
            for stage, columns, seen in self.marks
        ]
        return self.last.sparkSession.createDataFrame(
            rows, "stage string, n_rows bigint, n_cols bigint, columns string"
        )
