"""Connected components of a link table, by contraction.

Every round each node takes the smallest of itself and its neighbours as parent, follows the parent once more, and
the links are rewritten between parents. A round at least halves the nodes that still have links, so the number of rounds
grows with the logarithm of the largest component. All steps are joins and aggregations with partial minima; each round's
tables are written out, so the plan does not grow and lost executors cost one round.

Defined cases: no links give no rows; repeated links and links to oneself change nothing; null ends are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """id and component (smallest id in reach) of every node of links (x, y)."""
    edges = links.select("x", "y").filter(F.col("x") != F.col("y"))
    edges = written(edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        parents = both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("near")).select(
            "id", F.least("id", "near").alias("parent")
        )
        parents = written(parents, "parents")
        second = parents.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        jumped = written(parents.join(second, "parent").select("id", F.col("grand").alias("root")), "roots")
        if labels is None:
            labels = jumped.select("id", F.col("root").alias("component"))
        else:
            moved = jumped.select(F.col("id").alias("component"), "root")
            labels = labels.join(moved, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
            labels = written(labels, "labels")
        ends_x = jumped.select(F.col("id").alias("x"), F.col("root").alias("a"))
        ends_y = jumped.select(F.col("id").alias("y"), F.col("root").alias("b"))
        moved = edges.join(ends_x, "x").join(ends_y, "y").filter(F.col("a") != F.col("b"))
        edges = written(moved.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("x").alias("id"), F.col("y").alias("component"))
    return labels
