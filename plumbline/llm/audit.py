"""How quality filters overlap and depend on their order."""

from __future__ import annotations

import hashlib
import string
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, require
from .common import Scratch, join_groups, stage, text_of
from .terms import global_shards, numbered_words, row_sums, term_shards

LETTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(LETTERS))
BIT = {x: 1 << i for i, x in enumerate(LETTERS)}
MASKS = 1 << len(LETTERS)

_UPPER = string.ascii_uppercase.encode()
_SYMBOLS = b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))  # all bytes of a character but its first


def _too_many_capitals(text: bytes) -> bool:
    capitals = len(text) - len(text.translate(None, _UPPER))
    return 100 * capitals > 10 * len(text.translate(None, _INNER))


FACTS = (
    ("capitals", pa.bool_(), _too_many_capitals),
    ("symbols", pa.bool_(), lambda text: len(text.translate(None, _SYMBOLS)) < len(text)),
    ("digest", pa.binary(), lambda text: hashlib.sha256(text).digest()),
)


def _labelled(labels: DataFrame, id_col: str) -> DataFrame:
    """``doc_id, good, toxic`` as 0 or 1; an identifier has a label that any of its rows has."""
    require(labels, [id_col, "quality", "toxic"])

    def has(name):
        return F.max(F.when(col(name) == 1, 1).otherwise(0))

    return labels.groupBy(col(id_col).alias("doc_id")).agg(
        has("quality").alias("good"), has("toxic").alias("toxic")
    )


def failures(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``doc_id, part, mask, n``: documents by the filters they fail (bit i: letter i), written.

    The counts of equal rows are added up. Words are numbered by a dictionary of
    all documents and counted in a sparse matrix; its row sums decide A and its
    non-zero cells B.
    """
    require(df, [id_col, part_col])
    rows = df.select(
        col(id_col).alias("doc_id"),
        F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
        text_of(df, text_col).alias("text"),
    )
    with Scratch(df.sparkSession) as scratch:
        shards = scratch.stage(term_shards(rows, bytes.split, FACTS), "shards")
        matrix = global_shards(shards, numbered_words(shards, scratch))
        flagged = scratch.stage(
            row_sums(matrix).select("doc_id", "part", "digest", _own_mask().alias("mask")), "flags"
        )
        copies = flagged.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("size"))
        copies = scratch.stage(copies.filter("size > 1"), "copies")
        later = join_groups(flagged, copies, ["digest"], flagged.count())
        later = later.filter(F.col("doc_id") > F.col("first"))
        moved = F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.lit(-1).alias("k")),
                F.struct((F.col("mask") + BIT["E"]).alias("mask"), F.lit(1).alias("k")),
            )
        )
        every = flagged.select("doc_id", "part", "mask", F.lit(1).alias("k")).unionByName(
            later.select("doc_id", "part", moved.alias("m")).select("doc_id", "part", "m.*")
        )
        counted = every.groupBy("doc_id", "part", "mask").agg(F.sum("k").alias("n"))
        return stage(counted.filter("n != 0"), "failures")


def _own_mask() -> Column:
    """The filters that a document fails by itself."""

    def bit(letter: str, fails: Column) -> Column:
        return F.when(fails, BIT[letter]).otherwise(0)

    n, distinct = F.col("n_words"), F.col("n_distinct")
    return (
        bit("A", n < 100) + bit("B", 100 * distinct < 80 * n)
        + bit("C", F.col("capitals")) + bit("D", F.col("symbols"))
    )


def filter_audit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Five filters in all 120 orders, per value of ``part_col``.

    A fails under 100 words (what white space separates, case-sensitive), B where
    100 times the distinct words are fewer than 80 times the words, C where 100 times the
    letters A-Z are more than 10 times the characters, D on any of ``#$%&*|``, E on a
    text that a smaller identifier of the whole table has too.

    One row, zeros included, per ``part``, ``filter_order`` and ``step`` (from 1; its
    filter is that letter), with counts of documents: ``kept`` after the step, ``removed`` by
    it, ``redundant`` (failing it but removed before), ``unique_fails`` (failing it
    only), ``good_lost`` and ``toxic_lost`` (removed here, label 1) and ``shapley`` (removed by
    this filter, summed over all orders).

    A null text is empty; a null part is the empty string. A null identifier is
    smaller than none and has no label. Repeated rows count each and do not fail E
    for each other, as their identifiers are equal. An identifier with several labels has a label
    that any of them gives. An empty table gives an empty result. Other columns are ignored.

    Orders need no second look at the documents: a document counts for its part
    and the set of filters it fails, and each step adds up some of those 32 counts.
    """
    docs = failures(df, id_col, text_col, part_col)
    docs = docs.join(_labelled(labels, id_col), "doc_id", "left")
    per_mask = docs.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )

    def by_mask(name):
        each = [F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(name))), F.lit(0)) for m in range(MASKS)]
        return F.array(*each).alias(name)

    parts = per_mask.groupBy("part").agg(by_mask("n"), by_mask("good"), by_mask("toxic"))
    before, bits = [], []
    for order in ORDERS:
        for i, letter in enumerate(order):
            before.append(sum(BIT[x] for x in order[:i]))
            bits.append(BIT[letter])
    at = F.explode(F.sequence(F.lit(0), F.lit(len(bits) - 1)))
    steps = parts.select("*", at.alias("at")).select(
        "part", "n", "good", "toxic",
        F.get(F.lit(list(ORDERS)), F.floor(F.col("at") / len(LETTERS)).cast("int")).alias("filter_order"),
        (F.col("at") % len(LETTERS) + 1).cast("int").alias("step"),
        F.get(F.lit(before), F.col("at")).alias("before"),
        F.get(F.lit(bits), F.col("at")).alias("bit"),
    )

    def total(name, holds, weight=lambda m: F.lit(1)):
        each = F.transform(name, lambda c, m: F.when(holds(m), c * weight(m)).otherwise(0))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    def fails(m):
        return m.bitwiseAND(F.col("bit")) != 0

    def gone(m):
        return m.bitwiseAND(F.col("before")) != 0

    def here(m):
        return fails(m) & ~gone(m)

    # In that share of the orders a filter is the first of those that a document fails.
    first_in = F.lit([0, *[len(ORDERS) // bin(m).count("1") for m in range(1, MASKS)]])
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == F.col("bit")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        total("n", fails, lambda m: F.get(first_in, m)).alias("shapley"),
    )
