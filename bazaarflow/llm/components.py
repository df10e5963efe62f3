"""Connected components of links, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarflow.llm.tasks import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with over any number of links ``(a, b)``.

    Every round ties the larger neighbours of each node, then the smaller ones, to
    the smallest; the number of links never grows and the rounds needed grow
    with the logarithm of the nodes. Roots themselves are not listed.
    """
    links = links.where(F.col("a") != F.col("b"))
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        if edges.groupBy("a").count().where(F.col("count") > 1).isEmpty() and edges.join(
            edges.select(F.col("b").alias("a")), "a", "left_semi"
        ).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = written(large.where(F.col("a") != F.col("b")).distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        tied = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = tied.union(least.select("a", F.col("least").alias("b"))).where(F.col("a") != F.col("b"))
        edges = written(small.distinct(), "links")
