"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Rounds after which a graph that still changes is reported as an error.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected ``a, b`` links.

    ``root`` is the smallest node of the component. Rounds alternate between the
    two star steps: every node links its larger neighbours to the smallest of its
    neighbourhood, then its smaller neighbours likewise. Each halves the distance
    to the root, so the rounds grow with the logarithm of the longest chain. A
    neighbourhood is only ever reduced to its minimum (with partial aggregation)
    and joined to it, never gathered. Every round is written to the shared folder.
    """
    links = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b")
        .distinct(),
        "links",
    )
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(MAX_ROUNDS):
        large = _star(links.union(links.select("b", "a").toDF("a", "b")), larger=True)
        small = stage(_star(large, larger=False), "links")
        changed = _fingerprint(small) != _fingerprint(links)
        links = small
        if not changed:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours, and itself, to its smallest one.

    ``a`` is the centre and ``b`` a neighbour; for the small step the centre is
    the larger end of each link, so the minimum is over its smaller neighbours.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    if larger:
        least = least.withColumn("m", F.least("a", "m"))
        moved = links.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a > b").distinct()
