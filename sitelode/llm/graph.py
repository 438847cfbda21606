"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``links`` (``a, b``); the root is the least vertex of its component.

    Large-star and small-star steps alternate until nothing moves, which takes a number
    of rounds that grows with the logarithm of the longest chain. Minima are combined
    before the shuffle. The joins bring the links of a vertex together, narrow rows of two
    numbers; where one vertex has very many, Spark's skew join splits them.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every larger neighbour of a vertex moves to the least of its neighbourhood.
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("up")).join(least, "a")
        large = large.select(F.col("up").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: the same for the smaller neighbours and the vertex itself.
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        )
        edges = cut_lineage(small.select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("vertex"), "root")
    return cut_lineage(
        roots.union(roots.select(F.col("root").alias("vertex"), "root").distinct()).distinct()
    )
