"""Connected components of a link table, by alternating large and small stars.

Each round replaces links by links to smaller nodes, with two aggregations and
two joins on the node; a node of many links is summed before the shuffle and its
join partition can be split. What a round makes is written to the shared folder, so
that the next reads as many partitions as it has rows for, and goes once it is read.
The last round is known by its nodes: each has larger neighbours only, or one neighbour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.session import removed, written_at


def _sides(links: DataFrame) -> DataFrame:
    """The links (a, b) from either end."""
    return links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _least(sides: DataFrame) -> DataFrame:
    """u, the least of its neighbours and their number."""
    return sides.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"), F.count("*").alias("n"))


def _large_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """links: a > b. Each node's larger neighbours are linked to the least of the node and its neighbours; links may repeat."""
    near = _sides(links).where("b > a")
    return near.join(least, near["a"] == least["u"]).select(F.col("b").alias("a"), F.least("u", "m").alias("b"))


def _small_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """links: a > b. Each node and its smaller neighbours are linked to the least of these."""
    made = links.join(least, links["a"] == least["u"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return made.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of a link (columns a, b); the root is the component's
    least node. Self links, repeated links and links with nulls add nothing."""
    spark = links.sparkSession
    kept: list[str] = []

    def step(df: DataFrame) -> DataFrame:
        found, path = written_at(df, "components")
        kept.append(path)
        return found

    links = step(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        least = step(_least(_sides(links)))
        if least.where("m < u AND n > 1").isEmpty():
            break
        large = step(_large_star(links, least))
        least = step(_least(large))
        links = step(_small_star(large, least))
        while len(kept) > 1:  # all but the last, the links that the next round reads
            removed(spark, kept.pop(0))
    links = links.checkpoint()
    for path in kept:
        removed(spark, path)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
