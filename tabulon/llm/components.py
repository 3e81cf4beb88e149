"""Connected components by minimum labels with pointer jumping, on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.tables import store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of each node that has an edge; the component is its smallest node.

    A round takes the least label around each node and then follows each label to its own label, so
    the number of rounds grows with the logarithm of a component's diameter rather than with it. Labels
    are combined before each shuffle; a hub's edges are split by adaptive execution.
    """
    both = store(
        edges.where(F.col(a) != F.col(b))
        .select(F.explode(F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(b).alias("u"), F.col(a).alias("v")))).alias("e"))
        .select("e.u", "e.v")
        .distinct()
    )
    labels = store(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("component")))
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = store(
            nearer.join(jump, "component", "left").select(
                "node", "old", F.least("component", F.coalesce("further", "component")).alias("component")
            )
        )
        labels = moved.select("node", "component")
        if moved.where("old != component").isEmpty():
            return labels
