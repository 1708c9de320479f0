"""Connected components of a graph of any size, by alternating star contractions on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestar.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that it can reach.

    Large-star ties every larger neighbour to the least one, small-star does so with the smaller neighbours; the number
    of rounds grows with the logarithm of the longest chain. Each round is a minimum per node (combined before its
    shuffle) and a join with it, so a node with very many links is never gathered in one place. Loops and repeated
    edges are allowed; an empty graph gives no rows.
    """
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.union(links.select(F.col("b"), F.col("a")).toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.toDF("a", "b")).distinct()
        after = staged(small, "links")
        # Stars are final once every link goes to a node that links to nothing smaller.
        if after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            break
        links = after
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
