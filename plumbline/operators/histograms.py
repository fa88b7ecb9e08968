"""Binned distributions: histograms, two-dimensional bins, facets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binning import bin_guess, bin_settled, edge, widen
from ..functions.columns import attach, col, number, present, require, safe_ratio, settle
from ..functions.stats import pair_corr, pair_count

# More pairs of columns than this are counted in blocks, not by a row per pair.
WIDE_PAIRS = 15
BLOCK_ROWS = 1 << 16


def _extents(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Widened (lo_i, hi_i) and count n_i of each column per key, from one aggregate."""
    raw = df.groupBy(*[col(k) for k in keys]).agg(
        *[
            f(number(c)).alias(f"{name}{i}")
            for i, c in enumerate(cols)
            for name, f in (("a", F.min), ("b", F.max), ("n", F.count))
        ]
    )
    ends = []
    for i in range(len(cols)):
        lo, hi = widen(F.col(f"a{i}"), F.col(f"b{i}"))
        ends += [lo.alias(f"lo{i}"), hi.alias(f"hi{i}"), F.col(f"n{i}")]
    return raw.select(*[col(k) for k in keys], *ends)


def _staged(df: DataFrame, keep: Sequence[Column], cols: Sequence[str], lo, hi, bins: int) -> DataFrame:
    """``keep`` and the bin number ``_b{i}`` of each column; ``lo(i)``, ``hi(i)`` are its ends.

    Value, first guess and bin are projected in steps, so each is computed once.
    """
    some = range(len(cols))
    ends = [f(i).alias(f"_{name}{i}") for i in some for name, f in (("lo", lo), ("hi", hi))]
    out = df.select(*keep, *[number(c).alias(f"_v{i}") for i, c in enumerate(cols)], *ends)
    kept = [col(c) for c in out.columns[: len(out.columns) - 3 * len(cols)]]
    place = lambda i: (F.col(f"_lo{i}"), F.col(f"_hi{i}"), bins)
    out = out.select("*", *[bin_guess(F.col(f"_v{i}"), *place(i)).alias(f"_g{i}") for i in some])
    return out.select(
        *kept, *[bin_settled(F.col(f"_v{i}"), F.col(f"_g{i}"), *place(i)).alias(f"_b{i}") for i in some]
    )


def _count_cells(binned: DataFrame, group: Sequence[Column], cells: Sequence[Column]) -> DataFrame:
    """Rows per (group, cell number); a missing cell is left out."""
    return (
        binned.select(*group, F.explode(F.array(*cells)).alias("cell"))
        .filter(F.col("cell").isNotNull())
        .groupBy(*group, "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _count_pairs(binned: DataFrame, key: str | None, pairs: Sequence[tuple[int, int]], bins: int) -> DataFrame:
    """Rows per ([key,] cell number) as ``_count_cells`` has them, for many pairs.

    Tasks count the cells of a block of rows pair by pair, so no row is repeated per pair.
    """
    square = bins * bins
    width = 1 + max(i for pair in pairs for i in pair)
    head = [] if key is None else [col(key).alias("_k")]
    rows = binned.select(*head, *[F.coalesce(F.col(f"_b{i}").cast("int"), F.lit(-1)).alias(f"_b{i}") for i in range(width)])

    def counted(table: pa.Table) -> Iterator[pa.RecordBatch]:
        places = [table.column(f"_b{i}").to_numpy().astype("i8") for i in range(width)]
        code, labels = np.zeros(table.num_rows, "i8"), None
        if key is not None:
            coded = pa.concat_arrays(table.column("_k").chunks).dictionary_encode("encode")
            code, labels = coded.indices.to_numpy().astype("i8"), coded.dictionary
        for p, (a, b) in enumerate(pairs):
            both = (places[a] >= 0) & (places[b] >= 0)
            found, n = np.unique(code[both] * square + places[a][both] * bins + places[b][both], return_counts=True)
            cells = [pa.array(p * square + found % square), pa.array(n.astype("i8"))]
            if labels is not None:
                cells.insert(0, labels.take(pa.array(found // square)))
            yield pa.RecordBatch.from_arrays(cells, names=[*(["_k"] if key else []), "cell", "n"])

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in source:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield from counted(pa.Table.from_batches(held))
                held = []
        if held:
            yield from counted(pa.Table.from_batches(held))

    fields = [T.StructField("cell", T.LongType()), T.StructField("n", T.LongType())]
    if key is not None:
        fields.insert(0, T.StructField("_k", rows.schema["_k"].dataType))
    parts = rows.mapInArrow(scan, T.StructType(fields))
    summed = parts.groupBy(*parts.columns[:-1]).agg(F.sum("n").alias("n"))
    return summed if key is None else summed.withColumnRenamed("_k", key)


def histograms(
    df: DataFrame,
    cols: Sequence[str],
    bins: int = 30,
    density: bool = True,
    hue: str | None = None,
) -> DataFrame:
    """Histograms of many columns in two scans.

    Result: (variable, [hue,] bin, left, right, n, height), empty bins
    included. Each (variable, hue) has edges of its own. Missing values and
    missing hues are left out.
    """
    cols = require(df, cols)
    keys = [] if hue is None else require(df, [hue])
    group = [col(k) for k in keys]
    rows = present(df, keys)
    ends = settle(_extents(rows, cols, keys))
    if keys:
        used = rows.select(*[col(c) for c in dict.fromkeys([*keys, *cols])])
        placed = attach(used, ends, keys)
        binned = _staged(placed, group, cols, lambda i: F.col(f"lo{i}"), lambda i: F.col(f"hi{i}"), bins)
    else:
        only = ends.first()
        binned = _staged(
            rows, [], cols,
            lambda i: F.lit(only[f"lo{i}"]).cast("double"),
            lambda i: F.lit(only[f"hi{i}"]).cast("double"),
            bins,
        )
    counted = _count_cells(
        binned, group, [F.col(f"_b{i}") + F.lit(i * bins) for i in range(len(cols))]
    ).withColumns({"lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"), "total": F.lit(0).cast("bigint")})
    # Every cell once with a zero count; these rows also carry the edges.
    spans = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"), F.col(f"n{i}").alias("total")
            )
            for i in range(len(cols))
        ]
    )
    empty = (
        ends.select(*group, F.explode(spans).alias("e"))
        .filter(F.col("e.lo").isNotNull())
        .select(
            *group,
            F.explode(F.sequence(F.col("e.i") * bins, F.col("e.i") * bins + bins - 1)).alias("cell"),
            F.lit(0).cast("bigint").alias("n"),
            "e.lo",
            "e.hi",
            "e.total",
        )
    )
    both = (
        counted.unionByName(empty)
        .groupBy(*group, "cell")
        .agg(F.sum("n").alias("n"), F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.max("total").alias("total"))
        .withColumns(
            {
                "variable": F.element_at(F.array(*[F.lit(c) for c in cols]), F.floor(F.col("cell") / bins).cast("int") + 1),
                "bin": F.pmod("cell", F.lit(bins)),
            }
        )
    )
    left = edge(F.col("bin"), F.col("lo"), F.col("hi"), bins)
    right = edge(F.col("bin") + 1, F.col("lo"), F.col("hi"), bins)
    height = safe_ratio(F.col("n"), F.col("total") * (right - left)) if density else F.col("n").cast("double")
    return both.select(
        "variable", *group, "bin", left.alias("left"), right.alias("right"), "n", height.alias("height")
    )


def histogram(
    df: DataFrame, x: str, bins: int = 30, density: bool = True, hue: str | None = None
) -> DataFrame:
    """Equal-width histogram of one column, optionally per hue group."""
    return histograms(df, [x], bins, density, hue).drop("variable")


def pair_bins(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    keys: Sequence[Column] = (),
    bins: int = 20,
) -> DataFrame:
    """Two-dimensional counts of many column pairs in two scans.

    Result: (col1, col2, keys..., bin1, bin2, n), occupied cells only. Bins
    span each column's whole range, so groups share their edges.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    require(df, cols)
    ends = _extents(df, cols).first()
    group = list(keys)
    names = df.select(*group).columns if group else []
    binned = _staged(
        df, group, cols,
        lambda i: F.lit(ends[f"lo{i}"]).cast("double"),
        lambda i: F.lit(ends[f"hi{i}"]).cast("double"),
        bins,
    )
    at = {c: F.col(f"_b{i}") for i, c in enumerate(cols)}
    group = [col(k) for k in names]
    square = bins * bins
    if len(pairs) > WIDE_PAIRS and len(names) <= 1:
        places = [(cols.index(a), cols.index(b)) for a, b in pairs]
        counts = _count_pairs(binned, names[0] if names else None, places, bins)
    else:
        cells = [
            F.lit(p * square).cast("bigint") + at[a] * bins + at[b] for p, (a, b) in enumerate(pairs)
        ]
        counts = _count_cells(binned, group, cells)
    pair = F.floor(F.col("cell") / square).cast("int") + 1
    return counts.select(
        F.element_at(F.array(*[F.lit(a) for a, _ in pairs]), pair).alias("col1"),
        F.element_at(F.array(*[F.lit(b) for _, b in pairs]), pair).alias("col2"),
        *group,
        F.pmod(F.floor(F.col("cell") / bins), F.lit(bins)).cast("int").alias("bin1"),
        F.pmod(F.col("cell"), F.lit(bins)).cast("int").alias("bin2"),
        "n",
    )


def scatter_bins(df: DataFrame, x: str, y: str, hue: str | None = None, bins: int = 20) -> DataFrame:
    """Cell counts of x against y: ([hue,] bin_x, bin_y, n)."""
    keys = [] if hue is None else [col(k) for k in require(df, [hue])]
    return (
        pair_bins(df, [(x, y)], keys, bins)
        .withColumnsRenamed({"bin1": "bin_x", "bin2": "bin_y"})
        .drop("col1", "col2")
    )


def _both(x: str, y: str) -> tuple[Column, Column]:
    a, b = number(x), number(y)
    return F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)


def scatter_stats(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, means, standard deviations and correlation of the points."""
    a, b = _both(x, y)
    return df.groupBy(*[col(k) for k in require(df, keys)]).agg(
        F.count(a).alias("n"),
        F.avg(a).alias("mean_x"),
        F.avg(b).alias("mean_y"),
        F.stddev_pop(a).alias("sd_x"),
        F.stddev_pop(b).alias("sd_y"),
        pair_corr(a, b).alias("corr"),
    )


def scatter_points(
    df: DataFrame, x: str, y: str, hue: str | None = None, fraction: float = 1.0, seed: int = 0
) -> DataFrame:
    """The points themselves, optionally a seeded sample of them to draw."""
    names = list(dict.fromkeys([x, y] + ([hue] if hue else [])))
    points = df.select(*[col(c) for c in require(df, names)])
    points = present(points, [x, y])
    return points if fraction >= 1.0 else points.sample(fraction=fraction, seed=seed)


def facet_label(col_name: str, row: str | None = None) -> Column:
    """``row | col``, or the column's value alone."""
    if row is None:
        return col(col_name).cast("string")
    return F.concat_ws(" | ", col(row).cast("string"), col(col_name).cast("string"))


def facet_bins(
    df: DataFrame,
    x: str,
    y: str,
    col_name: str,
    row: str | None = None,
    hue: str | None = None,
    bins: int = 20,
) -> DataFrame:
    """Scatter bins split by one or two facet keys: (facet, [hue,] bin_x, bin_y, n)."""
    keys = [k for k in (row, col_name) if k]
    kept = present(df, require(df, keys))
    extra = [] if hue is None else [col(hue)]
    return (
        pair_bins(kept, [(x, y)], [facet_label(col_name, row).alias("facet"), *extra], bins)
        .withColumnsRenamed({"bin1": "bin_x", "bin2": "bin_y"})
        .drop("col1", "col2")
    )


def facet_grid_width(df: DataFrame, col_name: str) -> DataFrame:
    """Facets per row: the distinct values of the column facet."""
    return df.agg(F.count_distinct(col(col_name)).alias("n_cols"))


# Pairs whose moments fit one code-generated aggregate.
PAIRS_PER_PASS = 20


def pairwise_stats(df: DataFrame, cols: Sequence[str], hue: str | None = None) -> DataFrame:
    """(col1, col2, [hue,] n, corr) of every pair of numeric columns.

    Few pairs share one aggregate. More come from matrix products per Arrow
    batch, in two scans whatever the number of columns.
    """
    cols = require(df, cols)
    keys = [] if hue is None else [col(hue)]
    pairs = list(combinations(cols, 2))
    if len(pairs) > PAIRS_PER_PASS:
        return _matrix_stats(df, cols, hue)
    out = None
    for i in range(0, len(pairs), PAIRS_PER_PASS):
        some = pairs[i : i + PAIRS_PER_PASS]
        sums = df.groupBy(*keys).agg(
            *[pair_count(number(a), number(b)).alias(f"n{k}") for k, (a, b) in enumerate(some)],
            *[pair_corr(number(a), number(b)).alias(f"r{k}") for k, (a, b) in enumerate(some)],
        )
        cells = [
            F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(f"n{k}").alias("n"), F.col(f"r{k}").alias("corr"))
            for k, (a, b) in enumerate(some)
        ]
        part = sums.select(*keys, F.explode(F.array(*cells)).alias("c")).select(
            "c.col1", "c.col2", *keys, "c.n", "c.corr"
        )
        out = part if out is None else out.unionByName(part)
    return out


def _matrix_stats(df: DataFrame, cols: Sequence[str], hue: str | None) -> DataFrame:
    """Pair counts and correlations from products of values and presence marks.

    Values are shifted by their column's mean. A task sends one array per hue
    value: rows in common, sums, sums of squares and of products of each pair.
    """
    width = len(cols)
    means = df.agg(*[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shifted = [(number(c) - F.lit(means[i] or 0.0)).alias(f"x{i}") for i, c in enumerate(cols)]
    key = F.lit(0).alias("_h") if hue is None else col(hue).alias("_h")
    rows = df.select(key, *shifted)
    kind = rows.schema["_h"]
    floor = np.array([1e-14 * max(1.0, abs(means[i] or 0.0)) for i in range(width)]) ** 2
    first, second = np.triu_indices(width, 1)

    def whole(sums: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for h, flat in sums.items():
            columns = [pa.array([h], schema.field(0).type), pa.array([flat], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_h", "sums"])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        batch = None
        for batch in batches:
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(width)])
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            for k, h in enumerate(names):
                own, marks = x[codes == k], seen[codes == k].astype(float)
                parts = (marks.T @ marks, own.T @ marks, (own * own).T @ marks, own.T @ own)
                sums[h] = sums.get(h, 0.0) + np.concatenate([p.ravel() for p in parts])
        if sums:
            yield from whole(sums, batch.schema)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        batch = None
        for batch in batches:
            for h, flat in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[h] = sums.get(h, 0.0) + flat.values.to_numpy()
        for h, flat in sums.items():
            n, s, q, p = flat.reshape(4, width, width)
            with np.errstate(all="ignore"):
                mean = s / n
                spread = q / n - mean * mean
                corr = (p / n - mean * mean.T) / np.sqrt(spread * spread.T)
            flat_one = ~(spread > floor[:, None])
            corr[flat_one | flat_one.T] = np.nan
            value = corr[first, second]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h] * len(first), batch.schema.field(0).type),
                    pa.array(first, pa.int32()),
                    pa.array(second, pa.int32()),
                    pa.array(n[first, second].astype(np.int64)),
                    pa.array(value, pa.float64(), mask=np.isnan(value)),
                ],
                names=["_h", "a", "b", "n", "corr"],
            )

    def typed(*fields: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([T.StructField("_h", kind.dataType), *[T.StructField(n, t) for n, t in fields]])

    summed = rows.mapInArrow(products, typed(("sums", T.ArrayType(T.DoubleType()))))
    found = summed.repartition("_h").mapInArrow(
        finished, typed(("a", T.IntegerType()), ("b", T.IntegerType()), ("n", T.LongType()), ("corr", T.DoubleType()))
    )
    names = F.array(*[F.lit(c) for c in cols])
    keys = [] if hue is None else [F.col("_h").alias(hue)]
    return found.select(
        F.element_at(names, F.col("a") + 1).alias("col1"), F.element_at(names, F.col("b") + 1).alias("col2"),
        *keys, "n", "corr",
    )


def pairwise_scatter(
    df: DataFrame, cols: Sequence[str], hue: str | None = None, bins: int = 20
) -> DataFrame:
    """Cell counts of every pair of numeric columns: (col1, col2, [hue,] bin1, bin2, n)."""
    keys = [] if hue is None else [col(hue)]
    return pair_bins(df, list(combinations(require(df, cols), 2)), keys, bins)
