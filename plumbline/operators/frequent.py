"""Most frequent values, exact, without a shuffle of all values.

Every task keeps a summary of bounded size: counts of its most frequent values, and how
much any count may lack. Added up, the summaries bound every value's count, seen or not. A second
scan counts only the values that may be among the first; it is left out where nothing lacks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import attach, col, present, require, settle
from ..staging import staged
from .binned import CHUNK_ROWS
from .groups import long_categories

#: Values that a task keeps per column.
COUNTERS = 1024


def frequent_values(df: DataFrame, cats: Sequence[str], k: int) -> DataFrame:
    """(variable, category, n) of values that include the k most frequent of each column.

    A column is settled by its summary if the k-th largest lower bound exceeds what a value
    outside the summary can have, or if the summary is whole. Other columns, whose
    values are all about as rare, have all their values counted, which shuffles them.
    """
    cats = require(df, cats)
    with staged(_summaries(df, cats), "summaries") as parts:
        lacks = {r["i"]: r["lack"] for r in parts.groupBy("i").agg(F.sum("lack").alias("lack")).collect()}
        lower = parts.filter(F.col("category").isNotNull()).groupBy("i", "category").agg(F.sum("n").alias("n"))
        # The limit on the rank is applied in every task before rows meet.
        ranked = lower.withColumn("rank", F.row_number().over(Window.partitionBy("i").orderBy(F.col("n").desc())))
        first = ranked.filter(F.col("rank") <= k).groupBy("i").agg(F.min("n").alias("n"), F.max("rank").alias("found"))
        kth = {r["i"]: r["n"] for r in first.filter(F.col("found") == k).collect()}
        whole = [i for i in range(len(cats)) if not lacks.get(i)]
        proved = [i for i in range(len(cats)) if i not in whole and kth.get(i, 0) > lacks[i]]
        rest = [i for i in range(len(cats)) if i not in whole and i not in proved]
        names = F.array(*[F.lit(c) for c in cats])
        named = F.element_at(names, F.col("i") + 1).alias("variable")
        found = []
        if whole:
            # Written, since the summaries go at the end of the block.
            order = Window.partitionBy("i").orderBy(F.col("n").desc(), "category")
            exact = lower.filter(F.col("i").isin(whole)).withColumn("rank", F.row_number().over(order))
            found.append(settle(exact.filter(F.col("rank") <= k).select(named, "category", "n")))
        if proved:
            least = F.create_map(*[F.lit(x) for i in proved for x in (i, kth[i] - lacks[i])])
            likely = lower.filter(F.col("i").isin(proved)).filter(F.col("n") >= F.element_at(least, F.col("i")))
            rows = present(long_categories(df, [cats[i] for i in proved]), ["category"])
            asked = attach(rows, likely.select(named, "category"), ["variable", "category"], "left_semi")
            found.append(settle(_counted(asked)))
    if rest:
        found.append(_counted(present(long_categories(df, [cats[i] for i in rest]), ["category"])))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("variable", "category").agg(F.count(F.lit(1)).alias("n"))


def _summaries(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """``i, category, n, lack``: per task and column, counts that may lack up to the task's ``lack``.

    A value's count lies between n and n plus lack. The row with no category carries the lack.
    """
    most = COUNTERS

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [pd.Series(dtype="int64") for _ in cats]
        lacks = [0] * len(cats)
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            table = pa.Table.from_batches(held)
            for i, column in enumerate(table.columns):
                counts = column.drop_null().value_counts()
                new = pd.Series(counts.field("counts").to_numpy(), counts.field("values").to_pylist(), dtype="int64")
                both = pd.concat([kept[i], new]).groupby(level=0, sort=False).sum() if len(new) else kept[i]
                if len(both) > most:
                    cut = int(np.partition(both.to_numpy(), -most - 1)[-most - 1])
                    both = both[both > cut] - cut
                    lacks[i] += cut
                kept[i] = both
            held.clear()

        for batch in source:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                flush()
        if held:
            flush()
        for i in range(len(cats)):
            values, n = kept[i].index.tolist(), kept[i].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n) + 1, i, "i4")),
                    pa.array([None, *values], pa.string()),
                    pa.array(np.concatenate([[0], n]).astype("i8")),
                    pa.array(np.concatenate([[lacks[i]], np.zeros(len(n))]).astype("i8")),
                ],
                names=["i", "category", "n", "lack"],
            )

    texts = df.select(*[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cats)])
    return texts.mapInArrow(scan, "i int, category string, n long, lack long")
