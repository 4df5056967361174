"""Connected components of a table of links: smallest label by propagation with shortcuts, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of a link; label is the smallest node that can be reached.

    Joins and aggregates only: a hub's links are split like any skewed join, and its minimum is taken in the map
    tasks first. Each round lets labels travel one link and then jump to the label of the label.
    """
    both = stage(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(links.select(F.col(b).alias("u"), F.col(a).alias("v"))), "links"
    )
    labels = stage(
        both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels"
    )
    while True:
        carried = both.join(labels.withColumnRenamed("node", "u"), "u").groupBy(F.col("v").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(carried, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumps = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stage(
            moved.join(jumps, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels"
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
