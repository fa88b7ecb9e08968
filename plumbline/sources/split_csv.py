"""CSV with line breaks in quoted cells, read by as many tasks as its bytes allow.

A line belongs to the cell of an earlier one if the quotes before it are odd in number. So one
scan counts the quotes of every block of the file, a running sum over the few blocks tells
which begin inside a cell, and the second scan joins lines to records. Only records that
cross a block's edge are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import local_frame, settle, small_rows

WHOLE, HEAD, TAIL = 0, 1, 2
PIECES = "file string, block long, kind int, text string"


def records(spark: SparkSession, path: str) -> DataFrame:
    """``text``: one row per record, line breaks in quoted cells kept, blank lines and headers left out.

    Quotes must stand around cells and be doubled inside them; records end in a line feed,
    with or without a carriage return.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        F.col("value").alias("text"),
    )
    blocks = settle(lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)).cast("int").alias("inside"))
    small = small_rows(starts)
    if small is not None:
        found = lines.join(F.broadcast(local_frame(spark, small, starts.schema)), ["file", "block"])
    else:  # a shuffle mixes the lines, the sort puts them right
        placed = lines.withColumn("at", F.monotonically_increasing_id()).join(starts, ["file", "block"])
        found = placed.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    return _joined(found.select("file", "block", "inside", "quotes", "text").mapInArrow(_pieces, PIECES))


def _pieces(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the ends of those that a block's edge cuts."""
    now: tuple[str, int] | None = None
    inside, head, named, held = 0, False, True, []

    def batch(file: str, block: int, kinds: list[int] | np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(kinds, pa.int32()), texts]
        return pa.RecordBatch.from_arrays(columns, names=["file", "block", "kind", "text"])

    def rest() -> Iterator[pa.RecordBatch]:
        if not named:
            raise ValueError(f"the header of {now[0]} does not end in the file's first block")
        if held:
            yield batch(*now, [HEAD if head else TAIL], pa.array(["\n".join(held)]))
            held.clear()

    for part in source:
        files, blocks = part.column(0).to_pylist(), part.column(1).to_numpy()
        edges = [i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
        for first, last in zip([0, *edges], [*edges, len(files)]):
            if first == last:
                continue
            if now != (files[first], int(blocks[first])):
                if now is not None:
                    yield from rest()
                now = (files[first], int(blocks[first]))
                inside = part.column(2)[first].as_py()
                head, named = bool(inside), now[1] > 0
            quotes = part.column(3).slice(first, last - first).to_numpy()
            texts = part.column(4).slice(first, last - first)
            after = (inside + np.cumsum(quotes)) % 2
            if named and not inside and not held and not after.any():
                yield batch(*now, np.zeros(len(texts), "i4"), texts.cast(pa.string()))
                continue
            kinds, made = [], []
            for text, is_open in zip(texts.to_pylist(), after):
                held.append(text)
                if is_open:
                    continue
                if named:
                    kinds.append(HEAD if head else WHOLE)
                    made.append("\n".join(held))
                named = named or "".join(held) not in ("", "\r")
                head = False
                held.clear()
            inside = int(after[-1])
            yield batch(*now, kinds, pa.array(made, pa.string()))
    if now is not None:
        yield from rest()


def _joined(pieces: DataFrame) -> DataFrame:
    """All records; the pieces of cut ones in the order of their blocks."""
    whole = pieces.filter(F.col("kind") == WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    cut = pieces.filter(F.col("kind") != WHOLE).withColumn(
        "starts", F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    cut = cut.groupBy("file", "starts").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    text = F.regexp_replace("text", "\r\\z", "")
    return whole.select("file", text.alias("text")).unionByName(cut.select("file", text.alias("text"))).filter("text != ''")
