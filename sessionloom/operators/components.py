"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b), named by the least node of each component.

    Rounds of neighbour minima and pointer jumps until nothing changes; every round cuts its lineage. An empty table
    gives no rows; repeated links and links of a node to itself change nothing.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")))
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = label.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        jump = label.select(F.col("node").alias("low"), F.col("component").alias("jump"))
        step = cut(lower.join(jump, "low").select("node", F.col("component").alias("old"), F.least("low", "jump").alias("component")))
        label = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return label
