"""Exact search for the highest inner products: tiles of queries and shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, require
from .bpe import arrow_type
from .common import Scratch, id_type, shuffle_width, stage
from .merging import merge_tops, top_lists

#: Queries and rows of one tile, on average.
TILE_QUERIES = 32_768
TILE_ROWS = 16_384
#: Scores that a task holds at once.
SCORES = 1 << 22
LARGEST = (1 << 63) - 1


def _quantised(rows: DataFrame, scale: int) -> DataFrame:
    """``row, id, is_query, dim, v``: whole numbers ``floor(scale * x)`` as bytes.

    Numbers of at most 16 bits are kept so, others as doubles.
    """

    def run(source):
        for batch in source:
            lists = batch["vector"]
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(float(scale) * flat)
            ends = np.cumsum(sizes)
            wrong = np.r_[0, np.cumsum(~np.isfinite(whole))]
            fits = (wrong[ends] == wrong[ends - sizes]) & lists.is_valid().to_numpy(zero_copy_only=False)
            whole = whole[np.repeat(fits, sizes)]
            small = not len(whole) or np.abs(whole).max() < 1 << 15
            data = whole.astype("<i2" if small else "<f8")
            offsets = np.r_[0, np.cumsum(sizes[fits])] * data.itemsize
            v = pa.Array.from_buffers(
                pa.large_binary(), int(fits.sum()),
                [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(data.tobytes())],
            ).cast(pa.binary())
            kept = pa.array(fits)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c].filter(kept) for c in names], pa.array(sizes[fits], pa.int32()), v],
                names=[*names, "dim", "v"],
            )

    names = ["row", "id", "is_query"]
    kind = id_type(rows, "id").simpleString()
    return rows.mapInArrow(run, f"row long, id {kind}, is_query boolean, dim int, v binary")


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors as rows, shorter ones filled with zeros."""
    found = np.zeros((table.num_rows, width))
    dims, data = table["dim"].to_numpy(), table["v"].to_pylist()
    bytes_each = np.fromiter(map(len, data), "i8", len(data))
    for dim, size in {(int(d), int(b)) for d, b in zip(dims, bytes_each)}:
        if dim:
            here = np.flatnonzero((dims == dim) & (bytes_each == size))
            joined = b"".join([data[i] for i in here])
            found[here, :dim] = np.frombuffer(joined, "<i2" if size == 2 * dim else "<f8").reshape(-1, dim)
    return found


def _exact_kind(a: np.ndarray, b: np.ndarray):
    """The fastest number type in which no partial sum of the product is rounded."""
    most = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    bound = max(1, a.shape[1]) * max(1, most[0]) * max(1, most[1])
    for bits, kind in ((24, "f4"), (53, "f8"), (63, "i8")):
        if bound < 1 << bits:
            return kind
    return object


def _whole(a: np.ndarray, kind):
    if kind is object:
        return np.array([[int(x) for x in row] for row in a], object).reshape(a.shape)
    return a.astype(kind)


def _best_of_tile(queries: pa.Table, rows: pa.Table, k: int):
    """Per query the ``k`` best rows of the tile but its own: scores, positions and list ends."""
    width = max([0, *queries["dim"].to_pylist(), *rows["dim"].to_pylist()])
    a, b = _matrix(queries, width), _matrix(rows, width)
    kind = _exact_kind(a, b)
    a, b = _whole(a, kind), _whole(b, kind).T
    own, theirs = queries["row"].to_numpy(), rows["row"].to_numpy()
    n, take = len(theirs), min(k + 1, len(theirs))
    step = max(1, SCORES // n)
    scores, places, ends = [], [], []
    for start in range(0, len(own), step):
        tile = a[start : start + step] @ b
        if kind is object:
            tile = np.clip(tile, -LARGEST, LARGEST).astype("i8")
        least = np.partition(tile, n - take, axis=1)[:, n - take]
        for mine, line, low in zip(own[start : start + step], tile, least):
            here = np.flatnonzero(line >= low)
            # rows come by identifier, and the sort is stable
            here = here[np.argsort(-line[here], kind="stable")[:take]]
            here = here[theirs[here] != mine][:k]
            scores.append(line[here])
            places.append(here)
            ends.append(len(here))
    return np.concatenate(scores), np.concatenate(places), np.cumsum(ends)


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tile_queries: int = TILE_QUERIES,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each query row.

    Components become ``floor(scale * x)`` with x as double; the score is their
    integer inner product. Higher scores come first, equal ones by ``vec_id``, a null
    one first. Rows of ``df`` for which ``is_query`` is true are queries; all rows
    are candidates, but a row is none for itself. Repeated rows are rows of
    their own, so a query with a repeated identifier has a result for each of its rows.

    Vectors that are null, hold a null or non-finite component, or one that is no
    longer finite when scaled, take no part. A shorter vector counts as filled up
    with zeros. Scores beyond 64 bits are set to the nearest bound. Fewer than
    ``k`` others give fewer rows; an empty table gives an empty result. Other
    columns are ignored.

    Queries are dealt to blocks and candidates to shards, of bounded size
    whatever the table's. Every pair of a block and a shard is one tile: a matrix product
    whose best ``k`` per query are selected at once. The lists of a query's tiles
    are merged up a tree. Sums are taken in the narrowest type that rounds none.
    """
    require(df, [id_col, vector_col])
    spark = df.sparkSession
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        col(vector_col).alias("vector"),
    )
    with Scratch(spark) as scratch:
        held = scratch.stage(_quantised(rows, scale), "vectors")
        best = stage(_best(held, k, tile_queries, tile_rows), "best")
    return best.select("query_id", F.posexplode("top").alias("place", "t")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("t.id").alias("vec_id"),
        (-F.col("t.less")).alias("score"),
    )


def _best(held: DataFrame, k: int, tile_queries: int, tile_rows: int) -> DataFrame:
    """``query_id, top`` for the written vectors, a row for each query row."""
    n_rows, n_queries = held.agg(F.count("*"), F.count_if("is_query")).first()
    blocks = max(1, -(-n_queries // tile_queries))
    shards = max(1, -(-n_rows // tile_rows))

    def dealt(side, own, n_own, other, n_other):
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        place = F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int")
        # names of its own for each side, so that both may come from one table
        side = side.select("row", "id", "dim", "v", place.alias(own), every.alias(other))
        side = side.toDF(*side.columns)
        return side.repartition(width, "block", "shard").groupBy("block", "shard")

    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.take(pc.sort_indices(right["id"], null_placement="at_start"))
        scores, places, ends = _best_of_tile(left, right, k)
        ids = right["id"].combine_chunks().take(pa.array(places))
        return pa.Table.from_arrays(
            [
                left["row"], left["id"], pa.array(np.full(len(ends), key[1].as_py()), pa.int32()),
                top_lists(-scores.astype("i8"), ids, ends),
            ],
            schema=schema,
        )

    width = min(blocks * shards, 16 * shuffle_width(held.sparkSession))
    kind, arrow = id_type(held, "id").simpleString(), arrow_type(held, "id")
    schema = pa.schema(
        [("q", pa.int64()), ("query_id", arrow), ("node", pa.int32()),
         ("top", pa.list_(pa.struct([("less", pa.int64()), ("id", arrow)])))]
    )
    tiles = (
        dealt(held.filter("is_query"), "block", blocks, "shard", shards)
        .cogroup(dealt(held, "shard", shards, "block", blocks))
        .applyInArrow(tile, f"q long, query_id {kind}, node int, top array<struct<less: long, id: {kind}>>")
    )
    return merge_tops(tiles, ["q", "query_id"], k, shards)
