"""Connected components of a table of links, with joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.session import settle


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node that can be reached) for every node of ``links`` (columns a and b).

    Alternates two steps until only stars are left: every node hands its larger neighbours to its smallest one, then its
    smaller ones. Each step is a grouped minimum, combined before its shuffle,
    and a join that adaptive execution splits where a node has very many neighbours; tables are written in between, so
    the lineage stays short. The number of rounds grows with the logarithm of the longest path.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    # From here on a > b in every row.
    stars = settle(links.where(F.col("a") != F.col("b")).select(high, low).distinct(), "links")
    while not _are_stars(stars):
        both = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.where(F.col("b") > F.col("a")).join(nearest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(larger.where(F.col("a") != F.col("b")).distinct(), "links")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        smaller = large.join(lowest, "a").select(F.col("b").alias("x"), "m").where(F.col("x") != F.col("m"))
        small = smaller.select(F.col("x").alias("a"), F.col("m").alias("b")).unionAll(
            lowest.select("a", F.col("m").alias("b"))
        )
        stars = settle(small.distinct(), "links")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _are_stars(links: DataFrame) -> bool:
    """Does every node but the centres have one link, and lead to a centre?"""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    totals = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return totals.where(F.col("out") + F.col("into") > 1).where(F.col("out") > 0).isEmpty()
