"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import cut_lineage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node each node of the links reaches, the roots themselves left out.

    Alternating stars: a node's greater neighbours are pointed at its least one, then the smaller
    ones are, until nothing changes. A path halves in every round, so the rounds grow with the
    logarithm of the longest path; each one's links are written to the shared folder. Only minima
    meet at a node, and are taken before the shuffle too.
    """
    found = cut_lineage(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    before = None
    while True:
        state = found.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return found.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(both.filter("b < a").join(least, "a").filter("b = m").select("a", "b")).distinct()
        down = large.filter("a > b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        found = cut_lineage(
            down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
