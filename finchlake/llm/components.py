"""Connected components of a table of links, by rounds of smallest labels over neighbours and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.session import written


def component_labels(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of the component, for every node of ``links`` (x, y).

    Each round takes the smallest label among a node and its neighbours and then the label of that label,
    so the labels settle in few rounds even along chains. Only the count of changes reaches the driver.
    """
    both = written(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))), "links")
    nearest = both.groupBy("x").agg(F.min("y").alias("m"))
    labels = written(nearest.select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "y"), "y").groupBy("x").agg(F.min("label").alias("m"))
        near = labels.join(seen.withColumnRenamed("x", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = written(near.join(jump, "label").select(
            "node", "was", F.least("label", "beyond").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where(F.col("was") != F.col("label")).isEmpty():
            return labels
