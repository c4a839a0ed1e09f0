"""Connected components of a graph of links, by alternating star contractions.

Each step joins the links with the smallest neighbour of each node, which Spark
aggregates before its shuffle; no node's neighbours are ever gathered. The links of each
step are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select("low", "node"))
    least = both.groupBy("node").agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        both.join(least, "node")
        .where(F.col("low") > F.col("node"))
        .select(F.col("low").alias("node"), F.col("least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("node", "low").alias("node"), F.least("node", "low").alias("low"))
    least = down.groupBy("node").agg(F.min("low").alias("least"))
    joined = down.join(least, "node").select(F.col("low").alias("node"), F.col("least").alias("low"))
    return joined.where("node <> low").union(least.select("node", "least")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component, its smallest reachable node, for all nodes that have a link.

    Links are pairs of longs, in any direction and number; those with a null and those of
    a node with itself are left out.
    """
    now = links.select(F.col(a).alias("node"), F.col(b).alias("low"))
    now = stored(now.where("node <> low").distinct(), "links")
    mark = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            break
        mark = new
        now = stored(_small_star(_large_star(now)), "links")
    pairs = now.select("node", F.col("low").alias("component"))
    return pairs.union(now.select(F.col("low").alias("node"), "low")).distinct()
