"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plotwise.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node in links(a, b).

    Each round takes the smallest label among neighbours and then the label's own label, so
    paths halve. Sums and minima are partial aggregates and joins split skewed keys: a hub
    with a third of all links is not one task's work. Rounds are checkpointed in the shared
    folder. Links of a node to itself are allowed; there are no rounds without links.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = cut_lineage(both)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    labels = cut_lineage(labels)
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        low = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("component").alias("up"))
        new = low.join(up, "low").select("node", "component", F.least("low", "up").alias("new"))
        new = cut_lineage(new)
        changed = not new.filter("new < component").isEmpty()
        labels = new.select("node", F.col("new").alias("component"))
        if not changed:
            return labels
