"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

# Links that one task follows at most: fewer than these need no exchange, and more are dealt out as ever.
ONE_TASK = 1 << 17


def _gathered(df: DataFrame, few: bool) -> DataFrame:
    """The same rows, in one partition if they are few: joins and groups of such tables exchange nothing."""
    return df.coalesce(1) if few else df


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) for every node of a link; the component is its smallest node.

    Every step links nodes to the least neighbour of a neighbourhood, so the number of steps grows with
    the logarithm of the longest path. Links of a node to itself and repeated links do no harm; without
    links there are no nodes. The least neighbours are written, so that a node with very many links can be
    split. Up to ``ONE_TASK`` links are followed by the same steps in one task.
    """
    x, y = F.col(a).alias("a"), F.col(b).alias("b")
    edges = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where("a != b").distinct()
    edges = materialize(edges, "links")
    # the steps never make more edges than there are links
    few = edges.count() <= ONE_TASK

    def written(df: DataFrame, name: str) -> DataFrame:
        return _gathered(materialize(df, name), few)

    def least_of(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        return least if few else materialize(least, "least")

    edges, mark = _gathered(edges, few), None
    while True:
        both = _gathered(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), few)
        least = least_of(both).select("a", F.least("m", "a").alias("m"))
        large = written(
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b")
            .distinct(),
            "large-star",
        )
        joined = large.join(least_of(large), "a")
        chained = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = written(_gathered(chained, few).where("a != b").distinct(), "small-star")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == mark:
            break
        mark = now
    star = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
