"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import staged


def _star(both: DataFrame, keep) -> DataFrame:
    """Join every node's neighbours to the smallest node among them and itself. The smallest are written first: Spark splits
    the links of a hot node only where both sides of a join are plain exchanges."""
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least.hint("merge"), "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); a component is named by its smallest node.

    Links are replaced by links to smaller nodes until every node links to the smallest of its component; the number of
    steps grows with the logarithm of a component's size. Loops and repeated links are harmless; no link, no row.
    """
    links = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    while True:
        mirrored = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(mirrored, F.col("v") > F.col("u")).distinct()
        # Small star: each node's smaller neighbours, and itself, hang below the smallest of them.
        smaller = staged(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "large-star")
        own = smaller.select("u", F.col("u").alias("v")).distinct()
        after = _star(smaller.unionByName(own), F.lit(True)).distinct()
        after = staged(after.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
        if after.exceptAll(links).isEmpty() and links.exceptAll(after).isEmpty():
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        links = after
