"""Connected components of a graph given as edges, with joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import shared_table


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable from each node of the edges (a, b); nulls and loops are ignored.

    Each round hooks every node to its smallest neighbour, follows one more hook, and contracts the graph: edges move
    to the hooks' ends, and those inside one node vanish, so a round reads only what the last one left.
    The smallest node of a component is never hooked away and is what remains of it.  Every step is stored in the shared folder; a node
    with very many neighbours is reduced by partial aggregation before it is shuffled.
    """
    def contracted(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return shared_table(pairs.distinct(), f"{label}-edges")

    left, labels = contracted(edges), None
    while True:
        ends = left.select(F.col("a").alias("node"), "b").union(left.select(F.col("b").alias("node"), "a"))
        hooks = shared_table(ends.groupBy("node").agg(F.min("b").alias("least"))
                             .select("node", F.least("node", "least").alias("up")), f"{label}-hooks")
        further = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hooks = shared_table(hooks.join(further, "up").select("node", "top"), f"{label}-tops")
        if labels is None:
            labels = hooks.withColumnRenamed("top", "root")
        else:
            moved = labels.join(hooks.withColumnRenamed("node", "root"), "root", "left")
            labels = shared_table(moved.select("node", F.coalesce("top", "root").alias("root")), label)
        moved = (left.join(hooks.select(F.col("node").alias("a"), F.col("top").alias("top_a")), "a")
                 .join(hooks.select(F.col("node").alias("b"), F.col("top").alias("top_b")), "b"))
        left = contracted(moved.select(F.col("top_a").alias("a"), F.col("top_b").alias("b")))
        if left.isEmpty():
            return labels
