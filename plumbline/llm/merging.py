"""Lists of the best, merged pairwise up a tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lists that one node of the tree merges, on average.
FAN = 16


def top_lists(less: np.ndarray, ids: pa.Array, ends: np.ndarray) -> pa.ListArray:
    """Arrow lists of ``less, id``; list i ends at ``ends[i]``. ``less`` is the score, negated."""
    rows = pa.StructArray.from_arrays([pa.array(less, pa.int64()), ids], names=["less", "id"])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), rows)


def merge_tops(lists: DataFrame, keys: list[str], k: int, n_nodes: int) -> DataFrame:
    """One list ``top`` of the ``k`` best for each key.

    ``lists`` has the keys, ``node`` and ``top``, an array of ``less, id`` in any
    order; the least come first, equal ones by ``id``, null first. Every round
    merges some ``FAN`` lists to one, so no task gathers more than that many
    lists of a key, however many there are.
    """
    while True:
        n_nodes = -(-n_nodes // FAN)
        lists = lists.groupBy(*keys, F.pmod(F.xxhash64("node"), F.lit(n_nodes)).alias("node")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top")
        )
        if n_nodes <= 1:
            return lists.drop("node")
