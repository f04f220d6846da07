"""Connected components of an edge list, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import store


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b), root the smallest node it reaches.

    Each round every node takes the least label among itself and its
    neighbours, then the label of that label, so distances halve.  Minima are
    combined before they are shuffled; a hub only makes one side of a plain
    join large, which adaptive execution splits.  Every round is stored, so a
    lost executor costs at most one round, and lineage stays short.
    """
    both = store(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .filter("a <> b").distinct(), "edges")
    labels = store(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("root")), "labels")
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = store(step.join(jump, "root", "left").select(
            "node", "old", F.least("root", F.coalesce("next", "root")).alias("root")), "labels")
        labels = step.select("node", "root")
        if step.filter("old <> root").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
