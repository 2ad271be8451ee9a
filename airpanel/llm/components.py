"""Connected components of an undirected graph, by alternating large and small stars.

Each round links every node's neighbours to the smallest of them; no node's neighbours are gathered in one place,
because the smallest is an aggregate that is joined back. Rounds are written to the shared work folder; the
driver sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.batches import stored


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the smallest of u and its neighbours."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(smallest, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node. Loops are allowed."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "component-links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.union(edges.where("u = v"))
        down = _with_smallest(large)
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "component-links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        state = now
