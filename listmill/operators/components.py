"""Connected components of a link table, without ever collecting neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.engine import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node it is connected to.

    Each round moves links to the least neighbour, first those to larger nodes, then those to
    smaller ones (the two star steps of Kiveris et al.); links become stars in a number of rounds
    that grows with the logarithm of a component's size.
    """
    edges = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # every link now points from a larger to a smaller node
        smaller = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(smaller, "b")
            .select(F.col("m"), F.explode(F.array("a", "b")).alias("v"))
            .where("m < v")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))
            .distinct()
        )
        edges = cut(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state
