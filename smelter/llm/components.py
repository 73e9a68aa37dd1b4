"""Connected components of a graph of links, by alternating stars.

In a *large star* every node hands its larger neighbours to the smallest node it knows of,
in a *small star* its smaller ones. Both only ever make one row out of one row, so a node
with very many links costs what it has links; after a number of rounds that grows with the
logarithm of the longest path, every node is linked to the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.scratch import by_rows, stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that ``links`` (a, b: bigint) names; root: the component's smallest node.

    Links to oneself, repeated links and NULLs are allowed and add nothing. No links: no rows.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.distinct(), "links")
    seen = _digest(links)
    while True:
        links = stage(_small_star(_large_star(links, seen[0])), "links")
        now = _digest(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _large_star(links: DataFrame, number: int) -> DataFrame:
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = by_rows(ways.where("b > a"), number).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    """Equal for equal sets of links; two numbers, whatever their count."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())
