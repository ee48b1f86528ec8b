"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import shared


def components(links: DataFrame) -> DataFrame | None:
    """``node, component`` (the smallest node reachable) of all nodes of ``links`` (``a, b``); None without links.

    In each round every node points to its smallest neighbour or itself, and links
    are drawn between what their ends point to.  At least half of the nodes that
    have links left go in a round, and the smallest node of a component always
    stays.  Each round is written, so lost executors cost a round at most.
    Aggregations combine before they shuffle; joins may be split at hot nodes.
    """
    edges = shared.materialise(links.select("a", "b").filter("a <> b").distinct())
    if edges.isEmpty():
        return None
    known = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        points = shared.materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to")))
        if known is None:
            known = points.withColumnRenamed("to", "component")
        else:
            step = points.select(F.col("node").alias("component"), "to")
            known = shared.materialise(known.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        a, b = points.select(F.col("node").alias("a"), F.col("to").alias("x")), points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = shared.materialise(edges.join(a, "a").join(b, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if edges.isEmpty():
            return known
