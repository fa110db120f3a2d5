"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.support import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node of a link.

    Each round is written to the shared folder.  Large stars hang the larger neighbours of a node on its
    smallest neighbour, small stars the smaller ones; rounds are logarithmic in a component's width."""
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
            )).alias("e")).select("e.*").filter("u <> v").distinct()
        )
        after = stored(small, "links")
        if after.count() == edges.count() and after.exceptAll(edges).isEmpty():
            discard(edges)
            return after.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(
                after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        discard(edges)
        edges = after
