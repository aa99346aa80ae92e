"""Connected components of a link table by alternating star contraction.

Nothing but one checksum row a round reaches the driver; every round is
written to the shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.least("least", "a").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them (links have a > b)."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest linked node of every node that has a link: ``node``, ``root``.

    ``links`` has two long columns ``a`` and ``b``, in either order; loops
    and repeats are allowed, an empty table gives no rows.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = staged(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = mark(now)
    while seen[0]:
        now = staged(_small_star(_large_star(now)), "links")
        after = mark(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
