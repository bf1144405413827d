"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node of its component) for all nodes of ``edges`` (``a``, ``b``).

    Each round links every node to the least of its neighbours and keeps the
    components; the number of edges never grows, and rounds grow with the
    logarithm of the component size. A hub's edges meet by an aggregate with
    partial minima and a join that Spark can split.
    """
    links = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    seen = None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return links
        seen = mark
        links = stage(_small_star(_large_star(links)))


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to its least neighbour."""
    both = links.union(links.select("root", "node"))
    least = both.groupBy("node").agg(F.min("root").alias("best")).withColumn("best", F.least("best", "node"))
    return both.join(least, "node").filter("root > node").select(F.col("root").alias("node"), F.col("best").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of those."""
    least = links.groupBy("node").agg(F.min("root").alias("best"))
    joined = links.join(least, "node")
    return (joined.filter("root > best").select(F.col("root").alias("node"), F.col("best").alias("root"))
            .union(least.select("node", "best")).distinct())
