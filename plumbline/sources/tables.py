"""Tables in and out: CSV and Parquet, stage folders, mappings, selections."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, nan_to_null, require
from ..operators.cleaning import apply_featurizers, assemble_columns, drop_columns, drop_unlabeled
from ..operators.encoding import Preprocessor
from ..operators.polynomial import full_terms, interaction_terms
from ..spec import TableSpec
from .split_csv import records

FORMATS = ("csv", "parquet")
STAGES = ("raw", "clean", "processed", "product")

# Text cells read as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def format_of(path: str, fmt: str | None = None) -> str:
    """Format by argument or by suffix; anything else is an error."""
    fmt = fmt or PurePosixPath(path).suffix[1:]
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    return fmt


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    nan_as_null: bool = False,
    multi_line: bool | str = True,
) -> DataFrame:
    """Read a table.

    Parquet columns come as they are, so that filters reach the files; the
    operators treat NaN as missing. ``nan_as_null`` turns NaN into null here.

    CSV cells with a missing token are null. Types come from the schema or from
    one pass over the text: whole numbers (of any length up to 38 digits, none
    rounded), then decimals, then true/false, else text. Cells that do not fit a
    given schema become null. A row with more or fewer cells than the header is
    an error. Quoted cells may hold line breaks; with ``multi_line=False`` they
    may not, and one large file is read by several tasks. ``"split"`` allows both,
    if quotes stand only around cells and, doubled, inside them.
    """
    fmt = format_of(path, fmt)
    if fmt == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(path)
        return nan_to_null(df) if nan_as_null else df
    text = _csv_text(spark, path, schema, multi_line)
    if schema is None:
        schema = infer_schema(text)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    typed = text.select(*[_cast(f).alias(f.name) for f in schema.fields])
    return nan_to_null(typed)


#: How CSV cells are read, whatever cuts the text into records.
_CELLS = {
    "escape": '"', "mode": "FAILFAST", "columnPruning": False,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _csv_text(spark: SparkSession, path: str, schema, multi_line: bool | str) -> DataFrame:
    reader = spark.read.options(header=True, multiLine=bool(multi_line), **_CELLS)
    if schema is not None:
        names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    raw = reader.csv(path)
    if multi_line == "split":
        options = {k: str(v).lower() for k, v in {**_CELLS, "multiLine": True}.items()}
        cells = F.from_csv("text", ", ".join(f"`{c.replace('`', '``')}` string" for c in raw.columns), options)
        raw = records(spark, path).select(cells.alias("cells")).select("cells.*")
    return raw.select(
        *[F.when(~col(c).isin(*MISSING_TOKENS), col(c)).alias(c) for c in raw.columns]
    )


def _cast(field: T.StructField):
    if isinstance(field.dataType, T.StringType):
        return col(field.name)
    value = col(field.name)
    if isinstance(field.dataType, T.NumericType):
        value = F.trim(value)
    return value.try_cast(field.dataType)


def _whole(c):
    return F.trim(c).rlike(r"^[+-]?\d+$")


#: Kinds of cells, each number among the wider ones.
_LONG, _WHOLE, _DOUBLE, _BOOLEAN, _TEXT = range(5)


def _kind(c):
    """Kind of a present cell."""
    value = F.trim(c)
    number = value.try_cast("double").isNotNull() & ~value.rlike("[dDfF]$")
    whole = (
        F.when(value.try_cast("bigint").isNotNull(), _LONG)
        .when(value.try_cast("decimal(38,0)").isNotNull(), _WHOLE)
        .otherwise(_DOUBLE)
    )
    # Texts without a digit are seen by a pattern: a cast that fails is slow.
    return (
        F.when(_whole(c), whole)
        .when(value.rlike(r"\d|(?i:inf|nan)") & number, _DOUBLE)
        .when(c.isin("True", "False", "TRUE", "FALSE", "true", "false"), _BOOLEAN)
        .otherwise(_TEXT)
    )


def kinds_of_columns(text: DataFrame) -> DataFrame:
    """(at, low, high): least and greatest kind of the present cells of each column that has any.

    The cells go one by one through one test: a test per column makes code that is too long to be compiled.
    """
    cells = text.select(F.posexplode(F.array(*[col(c) for c in text.columns])).alias("at", "cell"))
    kinds = cells.filter(F.col("cell").isNotNull()).select("at", _kind(F.col("cell")).alias("kind"))
    return kinds.groupBy("at").agg(F.min("kind").alias("low"), F.max("kind").alias("high"))


def infer_schema(text: DataFrame) -> T.StructType:
    """Narrowest type that every present cell of a column fits, in one aggregate.

    What fits one number fits the wider ones, so a column has the type of its widest cell; it
    is text if only some of its cells are true or false.
    """
    found = kinds_of_columns(text).collect()
    types = [T.LongType(), T.DecimalType(38, 0), T.DoubleType(), T.BooleanType(), T.StringType()]
    kinds = {r["at"]: r["high"] if r["high"] != _BOOLEAN or r["low"] == _BOOLEAN else _TEXT for r in found}
    return T.StructType([T.StructField(c, types[kinds.get(i, _DOUBLE)]) for i, c in enumerate(text.columns)])


def write_table(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Replace the table at the path.

    The new table is written beside the old one and takes its place by a rename,
    so a failed or slow write leaves the old one as it was.
    """
    fmt, new = format_of(path, fmt), f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    if fmt == "csv":
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        df.write.options(header=True, escape='"', **keep).csv(new)
    else:
        df.write.parquet(new)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    target, fresh, old = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, new, f"{new}.old"))
    files = target.getFileSystem(conf)
    had = files.exists(target)
    if had and not files.rename(target, old):
        raise OSError(f"cannot move the table at {path} away")
    if not files.rename(fresh, target):
        if had:
            files.rename(old, target)
        raise OSError(f"cannot put the new table at {path}")
    if had:
        files.delete(old, True)


@dataclass(frozen=True)
class StageFolders:
    """Folders of the stages raw, clean, processed and product under one root."""

    root: str
    fmt: str = "parquet"

    def path(self, stage: str, name: str) -> str:
        if stage not in STAGES:
            raise ValueError(f"stage {stage!r} is not one of {STAGES}")
        return f"{self.root.rstrip('/')}/{stage}/{name}.{self.fmt}"

    def write(self, df: DataFrame, stage: str, name: str) -> str:
        path = self.path(stage, name)
        write_table(df, path, self.fmt)
        return path

    def read(self, spark: SparkSession, stage: str, name: str, schema=None) -> DataFrame:
        return read_table(spark, self.path(stage, name), self.fmt, schema)


def load_sample(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A named table of a folder of Parquet files; an unknown name is an error."""
    known = {"lineitem", "orders", "part", "documents", "labels", "events", "customer", "supplier"}
    if name not in known:
        raise ValueError(f"unknown sample {name!r}; have {sorted(known)}")
    return read_table(spark, f"{folder.rstrip('/')}/{name}.parquet")


def feature_base(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Listed columns dropped, unlabeled rows dropped, registered functions applied."""
    kept = drop_unlabeled(drop_columns(df, spec.drop_cols), spec.target)
    return apply_featurizers(kept)


def feature_sets(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """The tables base, poly1 (interactions) and poly2 (full second order)."""
    numeric = spec.numerics(df)
    return {
        "base": assemble_columns(df, spec),
        "poly1": assemble_columns(df, spec, interaction_terms(numeric)),
        "poly2": assemble_columns(df, spec, full_terms(numeric)),
    }


def write_feature_sets(
    df: DataFrame, spec: TableSpec, folder: str, fmt: str | None = None
) -> dict[str, str]:
    """Write base, poly1 and poly2.

    The base table is written first. As Parquet it then feeds the other two, so
    whatever led to it runs once; each of those is a scan with products.
    """
    fmt = format_of("", fmt or spec.fmt)
    base = feature_base(df, spec)
    paths = {name: f"{folder.rstrip('/')}/{name}.{fmt}" for name in ("base", "poly1", "poly2")}
    plain = TableSpec(spec.target, spec.target_type, spec.categorical, (), (), spec.key, fmt)
    write_table(feature_sets(base, plain)["base"], paths["base"], fmt)
    if fmt == "parquet":
        base = df.sparkSession.read.parquet(paths["base"])
    sets = feature_sets(base, plain)
    for name in ("poly1", "poly2"):
        write_table(sets[name], paths[name], fmt)
    return paths


def write_product(
    df: DataFrame, spec: TableSpec, folders: StageFolders, preprocessor: Preprocessor
) -> dict[str, str]:
    """Model input in the product stage: prepared columns ``X`` and target ``y``.

    Both carry the key columns, so that they can be joined again.
    """
    key = list(spec.key)
    labeled = drop_unlabeled(df, spec.target)
    return {
        "X": folders.write(preprocessor.transform(labeled, key), "product", "X"),
        "y": folders.write(labeled.select(*[col(c) for c in (*key, spec.target)]), "product", "y"),
    }


def write_mapping(mapping: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist a category mapping (column, category, code)."""
    _write_result(mapping.select(*require(mapping, ["column", "category", "code"])), path, fmt)


def read_mapping(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema("column string, category string, code int").format(fmt).load(path)


def write_selection(selection: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist a selection: (feature, decision, rank, hits, ...) or a subset front."""
    _write_result(selection, path, fmt)


def _write_result(df: DataFrame, path: str, fmt: str) -> None:
    if fmt not in ("json", "parquet"):
        raise ValueError("results are written as json or parquet")
    writer = df.write.mode("overwrite")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)


def selected_features(selection: DataFrame, decisions: Sequence[str] = ("confirmed",)) -> list[str]:
    """Names of the features with one of the decisions, best rank first."""
    rows = selection.filter(F.col("decision").isin(*decisions)).orderBy("rank", "feature").collect()
    return [r["feature"] for r in rows]
