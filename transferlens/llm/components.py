"""Connected components of a link table, without a link or a component ever leaving the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """Rows node, component (its smallest node) for every node of the links (a, b).

    Each round takes the smallest label among a node and its neighbours and then the label of that label, so labels travel
    twice as far each time. Every round is written to the shared folder; only the number of changes comes back.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = staged(labels.select("node", F.least("node", "near").alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"], "left")
        nearer = nearer.select("node", "component", F.least("component", "near").alias("next"))
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("top"))
        moved = nearer.join(up, nearer["next"] == up["up"], "left")
        moved = staged(moved.select("node", F.col("component").alias("old"), F.least("next", "top").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.filter("component <> old").isEmpty():
            return labels
