"""Connected components of a table of links, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.session import materialize, scratch


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)``; the root is the smallest node of its component.

    Each round hangs the larger neighbours of a node, then its smaller ones, on its smallest (large star, small
    star), until nothing changes. No neighbourhood is collected: minima combine on the map
    side, and a node with many links is split by the skew join. Every round is a table in the shared folder.
    """
    with scratch() as keep:
        edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        edges = materialize(edges, "links")
        before = _state(edges)
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            smallest = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            edges = small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
            edges = materialize(edges, "links")
            after = _state(edges)
            if after == before:
                roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
                keep(edges)
                return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
            before = after
