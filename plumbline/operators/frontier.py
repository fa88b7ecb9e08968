"""Rows not dominated under one minimized and one maximized objective, or under several (O2)."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import attach, number, require
from ..staging import stage_table

#: Cuts of the first objective in one pass, a power of two less one.
CUTS = 63
#: Passes stop once one leaves more than this share of the rows.
SHARE = 0.5
#: Rows of the last step's slices.
SLICE_ROWS = 100_000


def pareto_front(df: DataFrame, minimize: str, maximize: str) -> DataFrame:
    """Front rows, ties kept.

    A sketch cuts the first objective into slices; one map-side aggregate gives
    the best second objective of each, and a second scan keeps the rows above the
    best of all earlier slices. Nothing is shuffled until the passes have left
    few rows. The exact front of those is taken in slices, each compared with the
    best of the slices before it, so no task sees the whole order.
    """
    require(df, [minimize, maximize])
    points = df.select(number(minimize).alias("_a"), number(maximize).alias("_b")).dropna()
    while True:
        kept, rows = _above_earlier(points)
        if kept is None:
            break
        points = stage_table(kept, "front")
        if points.count() > SHARE * rows:
            break
    best = points.groupBy("_a").agg(F.max("_b").alias("_b"))
    front = _strict_front(stage_table(best, "front")).select("_a", "_b")
    return attach(
        df.withColumns({"_a": number(minimize), "_b": number(maximize)}), front, ["_a", "_b"]
    ).select(*df.columns)


def _cuts(points: DataFrame, count: int) -> list[float]:
    shares = [i / (count + 1) for i in range(1, count + 1)]
    found = points.agg(F.percentile_approx("_a", shares, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def _slice(value: Column, cuts: list[float], first: int = 0) -> Column:
    """Number of cuts below the value, as a balanced tree of comparisons."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value <= F.lit(cuts[middle]), _slice(value, cuts[:middle], first)).otherwise(
        _slice(value, cuts[middle + 1 :], first + middle + 1)
    )


def _above_earlier(points: DataFrame) -> tuple[DataFrame | None, int]:
    """Rows above the best of earlier slices, and how many rows there were."""
    cuts = _cuts(points, CUTS)
    if len(cuts) < 2:
        return None, 0
    at = _slice(F.col("_a"), cuts)
    tops = {
        r["s"]: (r["top"], r["n"])
        for r in points.groupBy(at.alias("s")).agg(F.max("_b").alias("top"), F.count("*").alias("n")).collect()
    }
    before, bars = None, []
    for s in range(len(cuts) + 1):
        bars.append(before)
        top = tops.get(s, (None, 0))[0]
        if top is not None and (before is None or top > before):
            before = top
    bar = F.element_at(F.array(*[F.lit(b).cast("double") for b in bars]), at + 1)
    return points.filter(bar.isNull() | (F.col("_b") > bar)), sum(n for _, n in tops.values())


def _strict_front(points: DataFrame) -> DataFrame:
    cuts = _cuts(points, points.count() // SLICE_ROWS + CUTS)
    if not cuts:
        return points
    sliced = points.withColumn("_s", _slice(F.col("_a"), cuts))
    tops = sliced.groupBy("_s").agg(F.max("_b").alias("_top"))
    before = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice.
    tops = tops.withColumn("_prev", F.max("_top").over(before)).select("_s", "_prev")
    inside = Window.partitionBy("_s").orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)
    lowest = F.lit(float("-inf"))
    return (
        sliced.join(F.broadcast(tops), "_s")
        .withColumn("_in", F.max("_b").over(inside))
        .filter(
            F.col("_b") > F.greatest(F.coalesce(F.col("_prev"), lowest), F.coalesce(F.col("_in"), lowest))
        )
    )


# ---- several objectives --------------------------------------------------------------

#: Cells of the grid that prunes dominated rows, at most.
CELLS = 4_096
#: Local fronts that one task merges in a round.
MERGED = 8
#: Points of a front that one task may compare with each other; larger ones go tile by tile.
TILE_POINTS = 50_000


def pareto_front_of(df: DataFrame, minimize: Sequence[str] = (), maximize: Sequence[str] = ()) -> DataFrame:
    """Front rows under any number of objectives, ties kept.

    A row is dominated if another is no worse in every objective and better in one. Rows with a
    missing objective take no part. Sketched cuts make a grid: rows whose cell lies behind a
    non-empty one in every objective go in a scan without a shuffle. Each task keeps the front of its
    rows; fronts are merged a few at a time in rounds. A front too large for one task is cut
    into blocks, and every block is compared with every other, tile by tile.
    """
    names = require(df, [*minimize, *maximize])
    if not names:
        raise ValueError("name at least one objective")
    signed = [number(c) for c in minimize] + [-number(c) for c in maximize]
    keys = [f"_o{i}" for i in range(len(signed))]
    points = df.select(*[(v + F.lit(0.0)).alias(k) for v, k in zip(signed, keys)]).dropna()
    points = _in_open_cells(points)
    schema = ", ".join(f"{k} double" for k in keys)
    parts = max(1, points.rdd.getNumPartitions())
    found = stage_table(points.mapInArrow(_local_front, schema), "front")
    while True:
        count = found.count()
        if parts == 1 or count > TILE_POINTS:
            break
        parts = -(-parts // MERGED)
        found = stage_table(found.repartition(parts, *keys).mapInArrow(_local_front, schema), "front")
    if count > TILE_POINTS:
        found = stage_table(_front_by_tiles(found.distinct(), keys, count), "front")
    objectives = {k: v + F.lit(0.0) for k, v in zip(keys, signed)}
    return attach(df.withColumns(objectives), found, keys).select(*df.columns)


def _in_open_cells(points: DataFrame) -> DataFrame:
    """Points in cells that no non-empty cell dominates with room to spare."""
    keys = points.columns
    per = max(1, int(CELLS ** (1 / len(keys)) + 1e-9) - 1)
    shares = [i / (per + 1) for i in range(1, per + 1)]
    row = points.agg(*[F.percentile_approx(k, shares, 10_000).alias(k) for k in keys]).first()
    cuts = [sorted(set(row[k] or [])) for k in keys]
    at = [_slice(F.col(k), c) for k, c in zip(keys, cuts)]
    place = functools.reduce(lambda a, b: a * F.lit(per + 1) + b, at)
    full = np.zeros((per + 1,) * len(keys), bool)
    for r in points.select(place.alias("cell")).distinct().collect():
        full.flat[r["cell"]] = True
    behind = full
    for axis in range(full.ndim):  # a full cell before this one in every objective
        behind = np.logical_or.accumulate(behind, axis=axis)
        behind = np.roll(behind, 1, axis=axis)
        behind[(slice(None),) * axis + (0,)] = False
    closed = np.flatnonzero((behind & full).reshape(-1)).tolist()
    return points.filter(~place.isin(closed)) if closed else points


def front_of(points: np.ndarray) -> np.ndarray:
    """The distinct rows that no other row dominates; smaller is better."""
    left = np.unique(points, axis=0)
    left = left[np.argsort(left.sum(axis=1), kind="stable")]
    front = []
    while len(left):
        best = left[0]  # nothing with a larger sum dominates it, and what did is gone
        front.append(best)
        left = left[~(left >= best).all(axis=1)]
    return np.array(front).reshape(-1, points.shape[1])


def _local_front(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, names = None, None
    for batch in source:
        names = batch.schema.names
        own = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        held = front_of(own if held is None else np.vstack([held, own]))
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T], names=names)


def _front_by_tiles(points: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The front of distinct points, each block compared with every block."""
    blocks = -(-count // TILE_POINTS)
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    own = points.select(*keys, block.alias("a"), every.alias("b"))
    other = points.select(*keys, every.alias("a"), block.alias("b"))
    other = other.toDF(*other.columns)

    def beaten(left: pa.Table, right: pa.Table) -> pa.Table:
        mine, theirs = (np.column_stack([t[k].to_numpy() for k in keys]).reshape(-1, len(keys)) for t in (left, right))
        out = np.zeros(len(mine), bool)
        for q in front_of(theirs):
            out |= (q <= mine).all(axis=1) & (q < mine).any(axis=1)
        return left.select(keys).filter(pa.array(out))

    schema = ", ".join(f"{k} double" for k in keys)
    lost = own.groupBy("a", "b").cogroup(other.groupBy("a", "b")).applyInArrow(beaten, schema)
    return points.join(lost.distinct(), keys, "left_anti")
