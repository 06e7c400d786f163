"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    hung = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung on the smallest of them. Links point down."""
    lowest = links.groupBy("a").agg(F.min("b").alias("low"))
    hung = links.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    return hung.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns a, b), named after its smallest node.

    A round costs two shuffles of the links; the rounds needed grow with the logarithm of the
    longest chain. Each round is a table in the shared folder, so that no round runs twice. Only a
    count and a sum reach the driver.
    """
    down = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(down.distinct())
    mark = _mark(now)
    while mark[0]:
        after = stored(_small_star(_large_star(now)))
        before, mark, now = mark, _mark(after), after
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
