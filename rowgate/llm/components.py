"""Connected components of a graph of links, by joins.

Every node takes the smallest label around it, then the label of that label
(pointer jumping), until nothing changes; rounds grow with the logarithm of a
component's diameter.  Each round is written to the shared folder, so neither
plans nor lineage grow, and only the number of changes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) from ``a, b``; any ordered type."""
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component"), F.lit(True).alias("changed"))
    labels = staged(labels, "labels")
    while not labels.where("changed").isEmpty():
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("seen")), "b")
                .groupBy("a").agg(F.min("seen").alias("seen")))
        best = (labels.join(near.withColumnRenamed("a", "node"), "node")
                .select("node", F.col("component").alias("old"), F.least("component", "seen").alias("best")))
        jump = labels.select(F.col("node").alias("best"), F.col("component").alias("far"))
        labels = staged(best.join(jump, "best").select(
            "node", F.least("best", "far").alias("component"), (F.least("best", "far") != F.col("old")).alias("changed")), "labels")
    return labels.select("node", "component")
