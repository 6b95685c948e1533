"""Connected components of a table of links, without gathering links or groups anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """Per node with a link: ``node`` and ``label``, the smallest node of its component. ``links`` has ``a`` and ``b``.

    Rounds of two steps, each of which hangs nodes on smaller ones: first the larger neighbours of a node on the
    smallest one near it, then the node and its smaller neighbours. Each component ends as a star. A node with very
    many links takes part in a minimum, which is taken before the shuffle, and in a join, which can be split.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    )
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = checkpointed(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        # Done when nothing changes: each node then hangs on the smallest one and on nothing else.
        if after.count() == edges.count() and after.exceptAll(edges).isEmpty():
            break
        edges = after
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots.select("node", F.col("node").alias("label")))
