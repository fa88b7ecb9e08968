"""What every text operator needs: clash-free inputs and written tables."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, require
from ..staging import new_path

#: White space that separates words: space and the controls 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, name: str) -> Column:
    """The text column as a string, null read as empty."""
    require(df, [name])
    return F.coalesce(col(name).cast("string"), F.lit(""))


def thin(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``doc_id`` and ``text``; other columns cannot clash with ours."""
    require(df, [id_col])
    return df.select(col(id_col).alias("doc_id"), text_of(df, text_col).alias("text"))


def boxed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Like ``thin`` with the whole input row kept in the struct ``row``."""
    require(df, [id_col])
    row = F.struct(*[col(c) for c in df.columns])
    return df.select(
        row.alias("row"), col(id_col).alias("doc_id"), text_of(df, text_col).alias("text")
    )


def with_text(df: DataFrame, columns: list[str], text_col: str, text: Column) -> DataFrame:
    """The boxed rows' columns with a new text; a column ``n_chars`` follows it."""
    new = {text_col: text}
    if "n_chars" in columns:
        new["n_chars"] = F.length(text).cast(df.schema["row"].dataType["n_chars"].dataType)
    return df.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Words between white space, in order."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


#: Steps of a running result that are walked as a whole; more are cut into blocks of so many.
BLOCK = 256


def running(values: Column, kind: str, add: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """``add`` of the first 1, 2, ... values; ``zero`` changes nothing.

    Each step copies what it made so far, so only short arrays are walked as a whole.
    Longer ones are walked block by block, then the ends of the blocks, which
    are added to what follows: ``n * BLOCK / 2`` copies and those of the ends.
    """
    none = F.lit(zero).cast(kind)

    def walk(part):
        start = F.struct(none.alias("v"), F.expr("array()").cast(f"array<{kind}>").alias("out"))

        def step(acc, x):
            v = add(acc["v"], x)
            return F.struct(v.alias("v"), F.concat(acc["out"], F.array(v)).alias("out"))

        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def blocked(whole):
        starts = F.sequence(F.lit(1), F.size(whole), F.lit(BLOCK))
        blocks = F.transform(starts, lambda s: walk(F.slice(whole, s, BLOCK)))
        return let(
            blocks,
            lambda own: let(
                walk(F.transform(own, lambda block: F.element_at(block, -1))),
                lambda ends: F.flatten(
                    F.transform(
                        own,
                        lambda block, i: let(
                            F.coalesce(F.get(ends, i - 1), none),
                            lambda end: F.transform(block, lambda v: add(end, v)),
                        ),
                    )
                ),
            ),
        )

    return let(values, lambda v: F.when(F.size(v) <= BLOCK, walk(v)).otherwise(blocked(v)))


_RECORDS: ContextVar[list[str] | None] = ContextVar("records", default=None)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of the tables that ``stage`` writes in the block."""
    paths: list[str] = []
    token = _RECORDS.set(paths)
    try:
        yield paths
    finally:
        _RECORDS.reset(token)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders_read(df: DataFrame) -> set[str]:
    """Names of the folders whose files the frame scans."""
    names, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths().iterator()
            while roots.hasNext():
                names.add(roots.next().getName())
    return names


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared folder once and scan the files from then on."""
    path = new_path(df.sparkSession, label)
    records = _RECORDS.get()
    if records is not None:
        records.append(path)
    return _written(df, path)


#: For tables whose rows have some MB each: the writer looks at its size after every row.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}


def _written(df: DataFrame, path: str, options: dict[str, str] | None = None) -> DataFrame:
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def single_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs of the block send rows to Python one by one, for rows of some MB each."""
    before = spark.conf.get(ROWS_PER_BATCH)
    spark.conf.set(ROWS_PER_BATCH, "1")
    try:
        yield
    finally:
        spark.conf.set(ROWS_PER_BATCH, before)


class Scratch:
    """Written tables that go at the end of a ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stage(self, df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
        self.paths.append(new_path(self.spark, label))
        return _written(df, self.paths[-1], options)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.paths)


#: A key with more than one of this many parts of all rows is hot.
HOT_PARTS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], n_rows: int) -> DataFrame:
    """Inner join of rows with one line per key, whose column ``size`` counts its rows.

    Keys with over a thousandth of the rows number fewer than a thousand, so
    their lines are broadcast and their rows stay where they are; all other rows
    are shuffled. Both inputs are read twice and should be written tables.
    """
    hot = F.broadcast(groups.filter(F.col("size") * HOT_PARTS > n_rows))
    cold = groups.filter(F.col("size") * HOT_PARTS <= n_rows)
    rest = rows.join(hot.select(*on), on, "left_anti").join(cold, on)
    return rows.join(hot, on).unionByName(rest)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
