"""Column helpers shared by every operator."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage_table

# A lookup above either bound is never broadcast or held by the driver.
SMALL_ROWS = 10_000
SMALL_BYTES = 16 * 1024 * 1024


def col(name: str) -> Column:
    """Column by exact name; names such as ``a b`` or ``a.b`` are legal here."""
    return F.col("`" + name.replace("`", "``") + "`")


def number(name: str) -> Column:
    """The column as double with NaN turned into null (one kind of missing)."""
    return not_nan(col(name).cast("double"))


def not_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every float and double column."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not fields:
        return df
    return df.withColumns(
        {f.name: F.nanvl(col(f.name), F.lit(None).cast(f.dataType)) for f in fields}
    )


def present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows where every named column is neither null nor NaN.

    Unlike ``dropna`` the null test is a plain predicate that file scans apply.
    """
    for name in names:
        df = df.filter(col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            df = df.filter(~F.isnan(col(name)))
    return df


def require(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The names as a list, or ValueError for a name the frame lacks."""
    names = list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}; have {df.columns}")
    return names


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Division giving null, not an ANSI error, where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def small_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """All rows of a small result, or None once it exceeds the stated bounds.

    Texts are cut to their even share of the bytes before they leave the tasks. Only if
    one is longer are the bytes added up; the rows come whole if all together fit.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    share = SMALL_BYTES // max(1, limit * len(texts))
    cut = df.withColumns({t: F.substring(col(t), 1, share + 1) for t in texts})
    rows = cut.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    if any(len(r[t] or "") > share for r in rows for t in texts):
        size = functools.reduce(operator.add, [F.coalesce(F.octet_length(col(t)), F.lit(0)) for t in texts])
        if df.agg(F.sum(size)).first()[0] > SMALL_BYTES:
            return None
        return df.collect()
    return rows


def local_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def settle(df: DataFrame) -> DataFrame:
    """An aggregated result, computed once, for plans that use it several times.

    Within the bounds it becomes a local relation; beyond them a written table.
    Catalyst would otherwise prune each use differently and scan the source for
    every one of them.
    """
    rows = small_rows(df)
    if rows is not None:
        return local_frame(df.sparkSession, rows, df.schema)
    return stage_table(df, "settled")


def attach(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join an aggregated lookup to the rows.

    The lookup is counted first. Within the bounds it is broadcast, so the rows
    stay where they are; beyond them the join shuffles and adaptive execution
    splits the skewed partitions.
    """
    rows = small_rows(lookup)
    if rows is not None:
        lookup = F.broadcast(local_frame(df.sparkSession, rows, lookup.schema))
    return df.join(lookup, on, how)
