"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge to another; root is the least node reachable.

    ``edges`` has the columns u and v. Each round hangs the larger neighbours of a node, then
    the smaller ones, on the least of them, which halves distances; every round is a written
    table. A node's neighbours are reduced by a minimum and joined back, never gathered. Minima
    are written first: Spark splits a hot node's rows only in a join of plain shuffled tables.
    Loops and repeated edges don't matter; null ends are ignored; no edges, no rows.
    """
    links = edges.where("u is not null and v is not null and u <> v")
    links = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    links = common.written(links.distinct(), "links")
    state = None
    while True:
        # Larger neighbours go to the least of the neighbourhood.
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = common.written(least, "least")
        large = around.where("v > u").join(least, "u").select("v", F.col("m").alias("u"))
        large = common.written(large, "large")
        # Smaller neighbours and the node itself go to the least of them.
        least = common.written(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        small = large.join(least, "v").where("u <> m").select(
            F.col("u").alias("v"), F.col("m").alias("u")
        )
        small = small.unionByName(least.select("v", F.col("m").alias("u")))
        links = common.written(small.select("u", "v").distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        state = now
