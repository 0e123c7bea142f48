"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import stored


def _toward_least(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are linked to the least of them all instead of to the node.

    ``large``: only neighbours above the node move; else only those below it (and the node itself).
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    moved = both.join(least, "a")
    out = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        down = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
        out = down.union(least.select("a", F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b; a > b) that connect the same nodes, pulled toward the least of each neighbourhood once."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    large = stored(_toward_least(links, True), "links")
    return stored(_toward_least(large, False), "links")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``links`` (a, b): the least node that its links lead to.

    Contracts until every link leads straight there; a few passes for star-like groups, and about the square of the
    logarithm of a group's size at worst.
    """
    mark = None
    while True:
        links = contracted(links)
        now = links.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.countDistinct("a").alias("d")
        ).first()
        if now == mark or not now["n"]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
        mark = now
