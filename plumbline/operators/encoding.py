"""Category encoders and scaling, fitted once and applied to any frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder as VectorEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import SMALL_ROWS, as_list, col, is_numeric, local_frame, number, present, require, small_rows
from ..functions.stats import digit
from ..spec import TableSpec
from ..staging import stage_table
from .cleaning import unpivot_one_row

UNSEEN = -1
MISSING = -2
# Up to this many categories the codes are literals inside the plan.
LITERAL_CODES = 64

MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("category", T.StringType(), True),
        T.StructField("code", T.IntegerType(), False),
    ]
)


def _long(df: DataFrame, cols: Sequence[str], *extra: Column) -> DataFrame:
    """One row (column, category, extra...) per row and listed column."""
    cells = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("category")) for c in cols]
    return df.select(F.explode(F.array(*cells)).alias("cell"), *extra).select(
        "cell.column", "cell.category", *[c for c in ("seen",) if extra]
    )


def _first_seen(df: DataFrame, cols: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Distinct (column, category) with the smallest order key of each."""
    if not order_by:
        return _long(df, cols).groupBy("column", "category").agg(F.lit(0).alias("seen"))
    key = F.struct(*[col(c) for c in require(df, order_by)]).alias("seen")
    return _long(df, cols, key).groupBy("column", "category").agg(F.min("seen").alias("seen"))


def number_rows(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Dense numbers from 1 inside each group, without one task per group.

    The frame is range-sorted by group and written; the sizes of the written parts give each
    part its offset. A group lies in neighbouring parts, so there are fewer sizes than parts
    and groups together.
    """
    placed = stage_table(
        df.orderBy(col(group), *order).withColumn("_at", F.monotonically_increasing_id()), "numbered"
    )
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part"), col(group)).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    total: dict = {}
    offsets = []
    for r in sorted(sizes.collect(), key=lambda r: (r[group], r["_part"])):
        offsets.append((r["_part"], r[group], total.get(r[group], 0) - r["_first"] + 1))
        total[r[group]] = total.get(r[group], 0) + r["_n"]
    table = df.sparkSession.createDataFrame(offsets, f"_part bigint, `{group}` string, _shift bigint")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), ["_part", group])
        .withColumn(name, (F.col("_at") + F.col("_shift")).cast("int"))
        .drop("_at", "_part", "_shift")
    )


def fit_categories(
    df: DataFrame, cols: str | Sequence[str], order_by: str | Sequence[str] = ()
) -> DataFrame:
    """Mapping (column, category, code): codes from 1 by first appearance.

    Without an order key, categories are numbered alphabetically. Missing is a
    category of its own when it occurs, sorted last if unordered.
    """
    return _fit_mapping(df, as_list(cols), as_list(order_by))[0]


def _fit_mapping(df: DataFrame, cols: list[str], order_by: list[str]) -> tuple[DataFrame, list | None]:
    """The mapping and, if it is small, its rows."""
    seen = _first_seen(df, require(df, cols), order_by)
    rows = small_rows(seen)
    if rows is None:
        order = [F.col("seen"), F.col("category").asc_nulls_last()]
        return number_rows(seen, "column", order, "code").select("column", "category", "code"), None
    coded = []
    for c in cols:
        mine = [r for r in rows if r["column"] == c]
        mine.sort(key=lambda r: (r["seen"], r["category"] is None, (r["category"] or "").encode()))
        coded += [(c, r["category"], i) for i, r in enumerate(mine, 1)]
    return local_frame(df.sparkSession, coded, MAPPING_SCHEMA), coded


def _category_counts(mapping: DataFrame, rows: list | None) -> dict[str, int]:
    """Categories per column, missing left out."""
    if rows is None:
        found = mapping.groupBy("column").agg(F.count("category").alias("n")).collect()
        return {r["column"]: r["n"] for r in found}
    counts: dict[str, int] = {}
    for column, category, _ in rows:
        counts[column] = counts.get(column, 0) + (category is not None)
    return counts


def _restricted(mapping: DataFrame, rows: list | None, cols: Sequence[str]) -> tuple[DataFrame, list | None]:
    """The part of a mapping about some columns; short enough to hold, if they are."""
    part = mapping.filter(F.col("column").isin(list(cols)))
    if rows is None:
        return part, small_rows(part.select("column", "category", "code")) if cols else []
    return part, [r for r in rows if r[0] in cols]


class OrdinalEncoder:
    """Codes from 1; a category unseen in fit is -1, an unseen missing is -2."""

    def __init__(self, cols: str | Sequence[str], order_by: str | Sequence[str] = ()):
        self.cols = as_list(cols)
        self.order_by = as_list(order_by)
        self.mapping: DataFrame | None = None
        #: The codes of each column that has at most ``SMALL_ROWS`` categories.
        self._known: dict[str, list[tuple[str | None, int]]] = {}

    def fit(self, df: DataFrame) -> OrdinalEncoder:
        return self._take(*_fit_mapping(df, self.cols, self.order_by))

    def use(self, mapping: DataFrame) -> OrdinalEncoder:
        """Take a mapping fitted earlier, for instance one read back from disk."""
        return self._take(mapping, small_rows(mapping.select("column", "category", "code")))

    def _take(self, mapping: DataFrame, rows: list | None) -> OrdinalEncoder:
        self.mapping = mapping
        if rows is None:
            rows = self._short_columns()
            counted = {r[0] for r in rows}
        else:
            counted = set(self.cols)
        self._known = {c: [] for c in self.cols if c in counted}
        for column, category, code in sorted(rows, key=lambda r: r[2]):
            if column in self._known:
                self._known[column].append((category, code))
        return self

    def _short_columns(self) -> list:
        """The mapping of the columns that are short by themselves, whatever the others are."""
        mine = self.mapping.filter(F.col("column").isin(self.cols))
        counts = {r["column"]: r["count"] for r in mine.groupBy("column").count().collect()}
        rows: list = []
        for c in self.cols:
            if counts.get(c, 0) <= SMALL_ROWS:
                rows += small_rows(mine.filter(F.col("column") == c).select("column", "category", "code")) or []
        return rows

    def categories(self, name: str) -> list[str | None]:
        if name not in self._known:
            raise ValueError(f"{name} has more than {SMALL_ROWS} categories; read the mapping table instead")
        return [category for category, _ in self._known[name]]

    def code(self, name: str) -> Column:
        """Code as an expression; the caller checked that it is short."""
        pairs = self._known[name]
        missing = next((code for category, code in pairs if category is None), MISSING)
        value = col(name).cast("string")
        found = F.lit(UNSEEN)
        known = [(category, code) for category, code in pairs if category is not None]
        if known:
            table = F.create_map(*[F.lit(v) for pair in known for v in pair])
            found = F.coalesce(F.try_element_at(table, value), F.lit(UNSEEN))
        return F.when(value.isNull(), F.lit(missing)).otherwise(found).cast("int")

    def apply(self, df: DataFrame, into: dict[str, str] | None = None) -> DataFrame:
        """Replace the columns by codes, or add them under the names in ``into``."""
        return self._coded(df, self.cols, into or {})

    def _coded(self, df: DataFrame, cols: Sequence[str], into: dict[str, str]) -> DataFrame:
        order = df.columns + [v for v in into.values() if v not in df.columns]
        for name in require(df, cols):
            target = into.get(name, name)
            if len(self._known.get(name, range(SMALL_ROWS))) <= LITERAL_CODES:
                df = df.withColumn(target, self.code(name))
                continue
            table = self.mapping.filter(F.col("column") == name).select(
                F.col("category").alias("_category"), F.col("code").alias("_code")
            )
            if name in self._known:
                table = F.broadcast(table)
            value = col(name).cast("string")
            df = (
                df.join(table, value.eqNullSafe(F.col("_category")), "left")
                .withColumn(
                    "_code",
                    F.coalesce(
                        F.col("_code"), F.when(value.isNull(), F.lit(MISSING)).otherwise(F.lit(UNSEEN))
                    ),
                )
                .withColumn(target, F.col("_code"))
                .drop("_category", "_code")
            )
        return df.select(*[col(c) for c in order])


class OneHotEncoder(OrdinalEncoder):
    """Columns ``c_1 .. c_k`` in code order; an unseen category is all zero.

    A column with more than ``SMALL_ROWS`` categories becomes one sparse vector
    of that many places instead.
    """

    def names(self, name: str) -> list[str]:
        return [f"{name}_{i}" for i in range(1, len(self._known[name]) + 1)]

    def indicators(self, name: str) -> list[Column]:
        value = col(name).cast("string")
        return [
            value.eqNullSafe(F.lit(category)).cast("int").alias(label)
            for label, category in zip(self.names(name), self.categories(name))
        ]

    def apply(self, df: DataFrame) -> DataFrame:
        long = [c for c in self.cols if c not in self._known]
        if long:
            df = self._vectors(df, long)
        out = []
        for c in df.columns:
            out += self.indicators(c) if c in self._known else [col(c)]
        return df.select(*out)

    def _vectors(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """Codes by join, then vectors; the place after the last one is left out."""
        tops = self.mapping.groupBy("column").agg(F.max("code").alias("top")).collect()
        sizes = {r["column"]: r["top"] for r in tops}
        coded, order = self._coded(df, cols, {}), df.columns
        for c in cols:
            place = F.when(col(c) > 0, col(c) - 1).otherwise(sizes[c]).cast("double")
            ends = df.sparkSession.createDataFrame([(0.0,), (float(sizes[c]),)], "_place double")
            model = VectorEncoder(inputCol="_place", outputCol="_vector", dropLast=True).fit(ends)
            coded = model.transform(coded.withColumn("_place", place))
            coded = coded.withColumn(c, col("_vector")).drop("_place", "_vector")
        return coded.select(*[col(c) for c in order])


class BaseNEncoder(OrdinalEncoder):
    """The ordinal code in base n, most significant digit first; unseen is all zero."""

    def __init__(self, cols: str | Sequence[str], base: int = 10, order_by: str | Sequence[str] = ()):
        super().__init__(cols, order_by)
        if base < 2:
            raise ValueError("base must be 2 or more")
        self.base = base

    def places(self) -> dict[str, int]:
        tops = {c: len(pairs) for c, pairs in self._known.items()}
        if len(tops) < len(self.cols):
            rows = self.mapping.groupBy("column").agg(F.max("code").alias("top")).collect()
            tops |= {r["column"]: r["top"] for r in rows}
        out = {}
        for c in self.cols:
            out[c] = 1
            while self.base ** out[c] <= tops.get(c, 0):
                out[c] += 1
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        places = self.places()
        coded = super().apply(df)
        out = []
        for c in coded.columns:
            if c not in self.cols:
                out.append(col(c))
                continue
            code = F.greatest(col(c), F.lit(0))
            for i in range(places[c]):
                out.append(digit(code, self.base, places[c] - 1 - i).alias(f"{c}_{i}"))
        return coded.select(*out)


def ordinal_encode(df, cols, order_by=()) -> DataFrame:
    return OrdinalEncoder(cols, order_by).fit(df).apply(df)


def onehot_encode(df, cols, order_by=()) -> DataFrame:
    return OneHotEncoder(cols, order_by).fit(df).apply(df)


def base_n_encode(df, cols, n: int = 10, order_by=()) -> DataFrame:
    return BaseNEncoder(cols, n, order_by).fit(df).apply(df)


def encode_categories(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Ordinal codes in place of the text categories among the predictors."""
    text = [c for c in spec.categories(df) if not is_numeric(df, c)]
    return ordinal_encode(df, text, spec.key) if text else df


def decode(df: DataFrame, mapping: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Codes back to category names; a code without a category becomes null."""
    order = df.columns
    rows = small_rows(mapping)
    for name in require(df, as_list(cols)):
        table = mapping.filter(F.col("column") == name).select(
            F.col("code").alias("_code"), F.col("category").alias("_category")
        )
        if rows is not None:
            table = F.broadcast(table)
        df = (
            df.join(table, col(name) == F.col("_code"), "left")
            .withColumn(name, F.col("_category"))
            .drop("_code", "_category")
        )
    return df.select(*[col(c) for c in order])


# Columns counted by one aggregate; each multiplies the rows of its expand step.
DISTINCT_PER_PASS = 10


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """(column, n_distinct) without missing values."""
    cols = require(df, cols)
    count = F.approx_count_distinct if approx else F.count_distinct
    out = None
    for i in range(0, len(cols), DISTINCT_PER_PASS):
        some = cols[i : i + DISTINCT_PER_PASS]
        values = [number(c) if df.schema[c].dataType.typeName() in ("float", "double") else col(c) for c in some]
        row = df.agg(*[count(v).alias(c) for c, v in zip(some, values)])
        part = unpivot_one_row(row, "column", "n_distinct")
        out = part if out is None else out.unionByName(part)
    return out


def distinct_values(df: DataFrame, name: str, order_by: str | Sequence[str] = ()) -> DataFrame:
    """Distinct values, sorted, or by first appearance under an order key."""
    rows = present(df, require(df, [name]))
    if not as_list(order_by):
        return rows.select(col(name)).distinct().orderBy(col(name))
    key = F.struct(*[col(c) for c in require(df, as_list(order_by))])
    return rows.groupBy(col(name)).agg(F.min(key).alias("_seen")).orderBy("_seen", col(name)).drop("_seen")


class Standardizer:
    """Mean 0 and population standard deviation 1; a flat column is only centred."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.params: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> Standardizer:
        cols = require(df, self.cols)
        if cols:
            row = df.agg(
                *[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                *[F.stddev_pop(number(c)).alias(f"s{i}") for i, c in enumerate(cols)],
            ).first()
            self.params = {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}
        return self

    def scaled(self, name: str) -> Column:
        mean, sd = self.params[name]
        return (number(name) - F.lit(mean)) / F.lit(sd)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.scaled(c) for c in require(df, self.cols)})


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return Standardizer(cols).fit(df).apply(df)


class Preprocessor:
    """Named column groups in the order numeric, ordinal, one-hot.

    Output names carry the group: ``st__`` scaled, ``dm__`` passed through,
    ``ord__`` ordinal code, ``oh__`` one-hot. Key and target columns given in
    ``keep`` pass through unchanged.
    """

    def __init__(
        self,
        numeric: Sequence[str],
        categorical: Sequence[str] = (),
        scaling: bool = False,
        encode: bool = True,
        threshold: int = 10,
        order_by: str | Sequence[str] = (),
    ):
        self.numeric = list(numeric)
        self.categorical = list(categorical)
        self.scaling = scaling
        self.encode = encode
        self.threshold = threshold
        self.order_by = as_list(order_by)
        self.ordinal: list[str] = []
        self.onehot: list[str] = []

    @classmethod
    def of(cls, df: DataFrame, spec: TableSpec, **options) -> Preprocessor:
        return cls(spec.numerics(df), spec.categories(df), order_by=spec.key, **options)

    def fit(self, df: DataFrame) -> Preprocessor:
        self.scaler = Standardizer(self.numeric if self.scaling else []).fit(df)
        self.ordinal, self.onehot = [], []
        if self.encode and self.categorical:
            # The distinct categories give both the codes and the cardinalities.
            mapping, rows = _fit_mapping(df, self.categorical, self.order_by)
            counts = _category_counts(mapping, rows)
            for c in self.categorical:
                (self.ordinal if counts.get(c, 0) > self.threshold else self.onehot).append(c)
            self.ord_encoder = OrdinalEncoder(self.ordinal, self.order_by)._take(mapping, rows)
            self.oh_encoder = OneHotEncoder(self.onehot, self.order_by)._take(
                *_restricted(mapping, rows, self.onehot)
            )
        return self

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        out = [col(c) for c in keep]
        if self.scaling:
            out += [self.scaler.scaled(c).alias(f"st__{c}") for c in self.numeric]
        else:
            out += [col(c).alias(f"dm__{c}") for c in self.numeric]
        if not self.encode:
            return df.select(*out, *[col(c).alias(f"dm__{c}") for c in self.categorical])
        if self.ordinal:
            df = self.ord_encoder.apply(df, {c: f"ord__{c}" for c in self.ordinal})
            out += [col(f"ord__{c}") for c in self.ordinal]
        for c in self.onehot:
            out += [
                flag.alias(f"oh__{label}")
                for flag, label in zip(self.oh_encoder.indicators(c), self.oh_encoder.names(c))
            ]
        return df.select(*out)

    def output_names(self, df: DataFrame) -> list[str]:
        return self.transform(df).columns


def auto_encode(df: DataFrame, spec: TableSpec, threshold: int = 10) -> DataFrame:
    """Ordinal codes above the cardinality threshold, one-hot columns up to it."""
    prep = Preprocessor([], spec.categories(df), threshold=threshold, order_by=spec.key).fit(df)
    return prep.transform(df, keep=[*spec.key, spec.target])
