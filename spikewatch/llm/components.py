"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spikewatch.llm.tables import keep


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the least node names it.

    A node should have a bounded number of links as ``a``; as ``b`` it may have any number.
    First all that an ``a`` is linked to is linked to the least of it instead, which leaves
    little more than one link per node of the many that similar nodes share.
    Every node takes the least name among its neighbours' and then that one's own name, which
    roughly doubles the distance names travel per round. Rounds end when no name changes.
    Each is written to the shared folder, so that lost executors cost one round at most.
    """
    least = F.least("a", F.min("b").over(Window.partitionBy("a"))).alias("least")
    stars = keep(links.filter("a != b").select("a", "b", least), "stars")
    ends = stars.select("a", "least").union(stars.select("b", "least")).toDF("a", "b")
    ends = ends.filter("a != b").distinct()
    both = keep(ends.union(ends.select("b", "a")).distinct(), "links")
    names = both.groupBy("a").agg(F.min("b").alias("b"))
    names = keep(names.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "names")
    while True:
        near = (
            both.join(names.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("component").alias("near"))
            .withColumnRenamed("a", "node")
        )
        nearer = names.join(near, "node").select(
            "node", F.least("component", "near").alias("next"), F.col("component").alias("before")
        )
        hop = names.select(F.col("node").alias("next"), F.col("component").alias("hop"))
        new = keep(
            nearer.join(hop, "next").select(
                "node",
                F.least("next", "hop").alias("component"),
                (F.least("next", "hop") != F.col("before")).alias("changed"),
            ),
            "names",
        )
        names = new.select("node", "component")
        if new.filter("changed").isEmpty():
            return names
