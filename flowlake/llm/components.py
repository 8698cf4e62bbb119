"""Connected components of an edge list, as Spark joins.

Every round each node takes the smallest label among itself and its neighbours,
then the label of its label (pointer jumping), until no label changes.  Star-shaped
input, which the operators send, settles in two or three rounds.  Each round is
written to the shared folder; nothing but a count reaches the driver.  Hubs are safe:
minima are partially aggregated and AQE splits the skewed join keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: for every node of an edge the smallest node reachable."""
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    both = written(one.union(one.select("v", "u")).distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("node"))
                     .agg(F.least(F.min("v"), F.col("u")).alias("root")), "labels")
    while True:
        near = (both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("root").alias("low")))
        stepped = (labels.join(near, labels.node == near.u)
                   .select("node", F.col("root").alias("old"), F.least("root", "low").alias("root")))
        up = stepped.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        jumped = written(stepped.join(up, stepped.root == up.n2, "left")
                         .select("node", "old", F.least("root", "r2").alias("root")), "labels")
        labels = jumped.select("node", "root")
        if jumped.filter("root <> old").isEmpty():
            return labels
