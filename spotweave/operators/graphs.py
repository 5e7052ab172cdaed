"""Connected components of graphs whose nodes and groups are too large for a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.sources.scratch import drop, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph of rows (u, v) over any values that have an order: the least node of each component.

    In turns every node hangs its larger neighbours, and then its smaller ones, on the least node it knows, until no edge changes: a
    number of turns that grows with the logarithm of the longest path, about.  A turn is grouped minima, combined before the
    shuffle, and joins of slim rows; its edges are written and those before them dropped.  Nodes without an edge
    to another don't appear.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        up = written(up, "edges")
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        after = written(down.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop(now, up)
        now = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", F.col("v").alias("c")).distinct())
