"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.sources.tables import written


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (a, b).

    In each round a node takes the least label among its own and its neighbours', and then the label of that label, which halves
    long paths. Rounds go on until nothing changes and are tables in the shared folder. No node meets more than its own
    links, which are reduced to a minimum before the shuffle.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("n_node")).agg(F.min("component").alias("least"))
        met = labels.join(near, labels.node == near.n_node) \
            .select("node", F.col("component").alias("old"), F.least("component", "least").alias("new"))
        up = labels.select(F.col("node").alias("u_node"), F.col("component").alias("up"))
        jumped = written(met.join(up, met.new == up.u_node, "left")
                         .select("node", "old", F.least("new", F.coalesce("up", "new")).alias("component")))
        labels = jumped.select("node", "component")
        if jumped.filter(F.col("old") != F.col("component")).isEmpty():
            return labels
