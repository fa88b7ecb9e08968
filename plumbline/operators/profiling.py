"""Whole-table report, associations and profiles against the target."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, is_numeric, number, present, require, safe_ratio
from ..functions.stats import pair_corr
from ..spec import TableSpec
from .cleaning import unpivot_one_row
from .encoding import cardinality
from .frequent import frequent_values
from .groups import counts_by, long_categories, means_by
from .histograms import histograms, pair_bins, pairwise_stats
from .quantiles import quantile_band, quantiles_and

QUARTILES = (0.25, 0.5, 0.75)
NUMBER_FIELDS = ("n", "n_missing", "mean", "sd", "min", "q25", "q50", "q75", "max", "skew", "kurtosis")


def target_correlation(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(variable, corr) of each numeric column with the target, largest first."""
    target = number(spec.target)
    cols = [spec.target, *spec.numerics(df)]
    row = df.agg(*[pair_corr(number(c), target).alias(c) for c in cols])
    return unpivot_one_row(row, "variable", "corr").orderBy(F.col("corr").desc_nulls_last(), "variable")


def _moments(values: dict[str, Column]) -> list[Column]:
    """Fused aggregates of several expressions, named ``field|label``."""
    out = []
    for label, v in values.items():
        out += [
            F.count(v).alias(f"n|{label}"),
            F.avg(v).alias(f"mean|{label}"),
            F.stddev(v).alias(f"sd|{label}"),
            F.min(v).alias(f"min|{label}"),
            F.max(v).alias(f"max|{label}"),
            F.skewness(v).alias(f"skew|{label}"),
            F.kurtosis(v).alias(f"kurtosis|{label}"),
        ]
    return out


def _summary_rows(df: DataFrame, values: dict[str, Column], approx: bool = False) -> DataFrame:
    """(label, fields...) for each expression: moments come with the quantile search.

    The frame must hold the expressions' columns; ``values`` maps label to
    expression. The report has one row per label, so it is built on the driver.
    """
    labels = list(values)
    frame = df.select(*[values[label].alias(f"c{i}") for i, label in enumerate(labels)])
    moments = _moments({f"c{i}": F.col(f"v{i}") for i in range(len(labels))})
    cuts, row = quantiles_and(
        frame, frame.columns, QUARTILES, approx, [F.count(F.lit(1)).alias("rows"), *moments]
    )
    out = []
    for i, label in enumerate(labels):
        get = lambda field: row[f"{field}|c{i}"]
        q25, q50, q75 = cuts[f"c{i}"]
        out.append(
            (label, get("n"), row["rows"] - get("n"), get("mean"), get("sd"), get("min"), q25, q50, q75,
             get("max"), get("skew"), get("kurtosis"))
        )
    doubles = ", ".join(f"{f} double" for f in NUMBER_FIELDS[2:])
    return df.sparkSession.createDataFrame(out, f"label string, n bigint, n_missing bigint, {doubles}")


def profile_numeric(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    approx: bool = False,
    approx_distinct: bool | None = None,
) -> DataFrame:
    """Count, missing, moments, quartiles, extremes and distinct count per numeric column.

    An exact distinct count shuffles every value of a continuous column;
    ``approx_distinct`` estimates it alone, by default with ``approx``.
    """
    cols = [c for c in df.columns if is_numeric(df, c)] if cols is None else require(df, cols)
    rows = _summary_rows(df, {c: number(c) for c in cols}, approx).withColumnRenamed("label", "variable")
    rough = approx if approx_distinct is None else approx_distinct
    distinct = cardinality(df, cols, rough).withColumnRenamed("column", "variable")
    return rows.join(F.broadcast(distinct), "variable", "left")


def profile_categorical(df: DataFrame, cats: Sequence[str], approx: bool = False) -> DataFrame:
    """(variable, n, n_missing, n_distinct) per categorical column."""
    cats = require(df, cats)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(col(c)).alias(c) for c in cats])
    rows = counts.unpivot(["_rows"], [col(c) for c in cats], "variable", "n")
    distinct = cardinality(df, cats, approx).withColumnRenamed("column", "variable")
    # One row per column on either side.
    return rows.select("variable", "n", (F.col("_rows") - F.col("n")).alias("n_missing")).join(
        F.broadcast(distinct), "variable"
    )


def top_values(df: DataFrame, cats: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values per column: (variable, category, n, rank).

    Equal counts are ranked by category. Bounded summaries find the values to count;
    ranks above k are cut before the shuffle as well as after it.
    """
    counts = frequent_values(df, cats, k)
    order = Window.partitionBy("variable").orderBy(F.col("n").desc(), "category")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def profile(df: DataFrame, spec: TableSpec, k: int = 10, approx: bool = False) -> DataFrame:
    """One long report: (variable, kind, field, value).

    Numeric fields, category counts, and ``top:<category>`` rows.
    """
    numeric = spec.numerics(df) + ([spec.target] if spec.numerical_target else [])
    cats = spec.categories(df) + ([] if spec.numerical_target else [spec.target])
    parts = []
    if numeric:
        wide = profile_numeric(df, numeric, approx)
        fields = [c for c in wide.columns if c != "variable"]
        parts.append(
            wide.select("variable", F.lit("numerical").alias("kind"), *[col(f).cast("double") for f in fields])
            .unpivot(["variable", "kind"], fields, "field", "value")
        )
    if cats:
        wide = profile_categorical(df, cats, approx)
        fields = ["n", "n_missing", "n_distinct"]
        parts.append(
            wide.select("variable", F.lit("categorical").alias("kind"), *[col(f).cast("double") for f in fields])
            .unpivot(["variable", "kind"], fields, "field", "value")
        )
        parts.append(
            top_values(df, cats, k).select(
                "variable",
                F.lit("categorical").alias("kind"),
                F.concat(F.lit("top:"), F.col("category")).alias("field"),
                F.col("n").cast("double").alias("value"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def compare_segments(
    df: DataFrame, predicate: Column, cols: Sequence[str], approx: bool = False
) -> DataFrame:
    """Summaries of two segments side by side with their difference.

    (variable, field, inside, outside, difference); rows for which the
    predicate is unknown belong to neither. Both segments share every scan.
    """
    cols = require(df, cols)
    sides = {"inside": predicate, "outside": ~predicate}
    values = {
        f"{side}|{c}": F.when(test, number(c)) for side, test in sides.items() for c in cols
    }
    fields = [f for f in NUMBER_FIELDS if f != "n_missing"]
    rows = _summary_rows(df, values, approx)
    side = F.substring_index("label", "|", 1)
    variable = F.expr("substring(label, instr(label, '|') + 1)")
    long = rows.select(
        side.alias("side"), variable.alias("variable"), *[col(f).cast("double") for f in fields]
    ).unpivot(["side", "variable"], fields, "field", "value")
    return (
        long.groupBy("variable", "field")
        .agg(*[F.max(F.when(F.col("side") == s, F.col("value"))).alias(s) for s in sides])
        .withColumn("difference", F.col("inside") - F.col("outside"))
    )


def associations(df: DataFrame, numeric: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """(col1, col2, kind, value) for every pair of columns.

    ``pearson`` between numerics, ``correlation_ratio`` from category to
    numeric, ``uncertainty`` U(col1 | col2) between categories, both ways.
    """
    numeric, cats = require(df, numeric), require(df, cats)
    parts = []
    if len(numeric) > 1:
        parts.append(
            pairwise_stats(df, numeric).select("col1", "col2", F.lit("pearson").alias("kind"), F.col("corr").alias("value"))
        )
    if numeric and cats:
        parts.append(_correlation_ratios(df, numeric, cats))
    if len(cats) > 1:
        parts.append(_uncertainty(df, cats))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _correlation_ratios(df: DataFrame, numeric: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """sqrt(between / total sum of squares) of each numeric by each category.

    Numerics are shifted by their mean first so the squares stay well scaled.
    """
    means = df.agg(*[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(numeric)]).first()
    shifted = [(number(c) - F.lit(means[f"m{i}"] or 0.0)).alias(f"x{i}") for i, c in enumerate(numeric)]
    rows = present(long_categories(df, cats, *shifted), ["category"])
    sums = []
    for i in range(len(numeric)):
        x = F.col(f"x{i}")
        sums += [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"q{i}")]
    groups = rows.groupBy("variable", "category").agg(*sums)
    totals = []
    for i in range(len(numeric)):
        n, s, q = F.col(f"n{i}"), F.col(f"s{i}"), F.col(f"q{i}")
        all_s, all_n = F.sum(s), F.sum(n)
        level = safe_ratio(all_s * all_s, all_n)
        between = F.sum(safe_ratio(s * s, n)) - level
        ratio = safe_ratio(between, F.sum(q) - level)
        totals.append(F.sqrt(F.greatest(ratio, F.lit(0.0))).alias(f"r{i}"))
    ratios = groups.groupBy("variable").agg(*totals)
    cells = [F.struct(F.lit(c).alias("col2"), F.col(f"r{i}").alias("value")) for i, c in enumerate(numeric)]
    return ratios.select(F.col("variable").alias("col1"), F.explode(F.array(*cells)).alias("c")).select(
        "col1", "c.col2", F.lit("correlation_ratio").alias("kind"), "c.value"
    )


def _uncertainty(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """U(col1 | col2) = (H(col1) - H(col1 | col2)) / H(col1) from pair counts."""
    pairs = list(combinations(cats, 2))
    cells = F.array(
        *[
            F.struct(F.lit(p).alias("p"), col(a).cast("string").alias("a"), col(b).cast("string").alias("b"))
            for p, (a, b) in enumerate(pairs)
        ]
    )
    joint = (
        df.select(F.explode(cells).alias("c"))
        .select("c.*")
        .dropna()
        .groupBy("p", "a", "b")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )

    def log_sum(frame: DataFrame, label: str) -> DataFrame:
        return frame.groupBy("p").agg(F.sum(F.col("n") * F.ln("n")).alias(label), F.sum("n").alias(f"t_{label}"))

    whole = log_sum(joint, "ab")
    rows = log_sum(joint.groupBy("p", "a").agg(F.sum("n").alias("n")), "ra")
    columns = log_sum(joint.groupBy("p", "b").agg(F.sum("n").alias("n")), "rb")
    # Each side has one row per pair of columns.
    table = whole.join(F.broadcast(rows), "p").join(F.broadcast(columns), "p")
    total = F.col("t_ab")
    entropy = {side: F.ln(total) - F.col(side) / total for side in ("ab", "ra", "rb")}
    shared = entropy["ra"] + entropy["rb"] - entropy["ab"]

    def share(own: Column) -> Column:
        return F.when(own > 1e-15, safe_ratio(shared, own)).otherwise(F.lit(1.0))

    first = F.array(*[F.lit(a) for a, _ in pairs])
    second = F.array(*[F.lit(b) for _, b in pairs])
    a, b = F.element_at(first, F.col("p") + 1), F.element_at(second, F.col("p") + 1)
    both = F.array(
        F.struct(a.alias("col1"), b.alias("col2"), share(entropy["ra"]).alias("value")),
        F.struct(b.alias("col1"), a.alias("col2"), share(entropy["rb"]).alias("value")),
    )
    return table.select(F.explode(both).alias("c")).select(
        "c.col1", "c.col2", F.lit("uncertainty").alias("kind"), "c.value"
    )


PROFILE_SCHEMA = ("variable", "kind", "hue", "category", "bin_x", "bin_y", "left", "right", "n", "value")


def _profile_shape(part: DataFrame, kind: str) -> DataFrame:
    types = {"hue": "string", "category": "string", "bin_x": "int", "bin_y": "int", "left": "double",
             "right": "double", "n": "bigint", "value": "double"}
    have = set(part.columns)
    return part.select(
        "variable",
        F.lit(kind).alias("kind"),
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()],
    )


def univariate_profile(
    df: DataFrame, spec: TableSpec, bins: int = 30, cells: int = 20, dense: bool = True
) -> DataFrame:
    """Every predictor against the target in one long table.

    Numeric target: ``scatter`` cells for numeric predictors and ``mean`` per
    category. Any target (a numeric one banded at its quartiles): ``hist`` per
    target group for numeric predictors, ``count`` per (category, group), with
    zeros for absent pairs unless ``dense`` is false.
    """
    numeric, cats = spec.numerics(df), spec.categories(df)
    parts = []
    if spec.numerical_target:
        if numeric:
            found = pair_bins(df, [(c, spec.target) for c in numeric], bins=cells)
            parts.append(
                _profile_shape(
                    found.select(F.col("col1").alias("variable"), F.col("bin1").alias("bin_x"), F.col("bin2").alias("bin_y"), "n"),
                    "scatter",
                )
            )
        if cats:
            parts.append(_profile_shape(means_by(df, cats, spec.target).withColumnRenamed("mean", "value"), "mean"))
        df = quantile_band(df, spec.target)
    if numeric:
        found = histograms(df, numeric, bins, True, spec.target)
        parts.append(
            _profile_shape(
                found.withColumnsRenamed({spec.target: "hue", "bin": "bin_x", "height": "value"}), "hist"
            )
        )
    if cats:
        parts.append(_profile_shape(counts_by(df, cats, spec.target, dense), "count"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
