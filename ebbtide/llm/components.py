"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to the smallest neighbour, so that every component ends
as a star around its smallest node after about log(n) rounds. Rounds are joins and
aggregates over the edges; each is written to shared storage, and nothing but two sums per
round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import dropped, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the node's smallest neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u != v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour smaller than a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.unionAll(own).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges(u, v)``.

    Duplicate edges, either direction and loops are allowed; nodes need an order.
    """
    now = stored(edges.select("u", "v").where("u != v").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == mark or not mark["n"]:
            break
        before = mark
        new = stored(_small_star(_large_star(now)), "edges")
        dropped(now)
        now = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
