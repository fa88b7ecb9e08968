"""Exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, shuffle_width, stage, thin


def digest_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sha, n_bytes, row``: a thin written table, one line per input row.

    ``row`` tells repeated rows apart; it is stable because the table is written.
    """
    rows = thin(df, id_col, text_col).select(
        "doc_id",
        F.unhex(F.sha2(F.col("text"), 256)).alias("sha"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stage(rows, "digests")


def tree_merge(runs: DataFrame, keep: str = "min", fan_in: int = 4) -> DataFrame:
    """One line per distinct text: ``sha, n_bytes, best, size``.

    The rows are dealt to ``fan_in ** levels`` runs, each a set of digests with
    its best identifier. In each round ``fan_in`` neighbouring runs exchange
    digest ranges: every partner takes one range of the group's digests and
    merges the others' sorted pieces of it, so all rounds keep the same number of
    workers and no run ever meets in one task. After the last round one group is
    left whose ranges cover the digests once. A hot digest shrinks to one line
    per run before the first exchange and to a ``fan_in``-th in each round.

    Equality is checked at every level: lines merge only where the whole SHA-256
    and the byte length agree.
    """
    width = max(2, shuffle_width(runs.sparkSession))
    levels = 1
    while fan_in**levels < width:
        levels += 1
    total = fan_in**levels
    pick = {"min": F.min, "max": F.max}[keep]
    merged = runs.select(
        F.pmod(F.xxhash64("row"), F.lit(total)).alias("run"),
        F.pmod(F.xxhash64("sha"), F.lit(total)).alias("home"),
        "sha",
        "n_bytes",
        F.struct("doc_id", "row").alias("best"),
        F.lit(1).cast("long").alias("size"),
    )
    for level in range(1, levels + 1):
        span = fan_in**level
        merged = (
            merged.withColumn("run", F.expr(f"run div {fan_in}"))
            .withColumn("owner", F.expr(f"run * {span} + home div {total // span}"))
            .groupBy("owner", "run", "home", "sha", "n_bytes")
            .agg(pick("best").alias("best"), F.sum("size").alias("size"))
        )
    return merged.select("sha", "n_bytes", "best", "size")


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    fan_in: int = 4,
) -> DataFrame:
    """One row per input row with the identifier that stays for its text.

    Result: ``doc_id, keep_id, group_size, kept, text_sha256``.

    * A null text counts as empty; empty texts form one group.
    * ``keep`` says whether the smallest or the largest identifier stays. A null
      identifier is smaller than any other.
    * Of repeated rows with one identifier and one text exactly one is kept.
    * An empty table gives an empty result. Other columns are ignored, whatever
      their names.

    The rows of hot texts are not moved for the last join.
    """
    runs = digest_runs(df, id_col, text_col)
    merged = stage(tree_merge(runs, keep, fan_in), "merged")
    return join_groups(runs, merged, ["sha", "n_bytes"], runs.count()).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
