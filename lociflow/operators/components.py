"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.session import written

#: How often a round follows the hooks: chains of 2 ** JUMPS hooks collapse at once.
JUMPS = 3


def connected_components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node each node is connected with.

    In every round each node hooks on its smallest smaller neighbour, hooks are followed a few
    times, and the edges are contracted to the new labels, so the edges shrink from round to round.
    Tables are written to the shared folder each round; the driver only learns whether edges are
    left. Null ends are left out; nodes without an edge have no row (a loop is an edge). Not
    settling within ``most_rounds`` is an error.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = written(known.unionByName(known.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = both.select("node").distinct().withColumn("component", F.col("node"))
    left = both.where("node <> other")
    for _ in range(most_rounds):
        if left.isEmpty():
            return labels
        hooks = left.groupBy("node").agg(F.min("other").alias("to")).where(F.col("to") < F.col("node"))
        for _ in range(JUMPS):
            hooks = written(hooks)
            on = hooks.select(F.col("node").alias("to"), F.col("to").alias("__further"))
            hooks = hooks.join(on, "to", "left").select("node", F.coalesce("__further", "to").alias("to"))
        hooks = written(hooks)
        moved = lambda df, column: df.join(hooks.select(F.col("node").alias(column), "to"), column, "left").withColumn(column, F.coalesce("to", column)).drop("to")  # noqa: E731, B023
        labels = written(moved(labels, "component").select("node", "component"))
        left = written(moved(moved(left, "node"), "other").where("node <> other").select("node", "other").distinct())
    raise RuntimeError("the components did not settle")
