"""Connected components of a link table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): every node of a link with the smallest node of
    its component.

    Each round hooks every node to its smallest neighbour (a partial
    aggregate, so a hub's many links meet only after they are combined),
    follows the hooks to their ends by doubling, replaces the links by links
    between those ends, and drops loops and repeats.  A chain of n nodes in the
    order of their ids takes one round and log2(n) doublings.  Both sides of
    the joins are tables read back, which lets Spark split a hot key.
    """
    edges = written(links.select("a", "b").filter("a <> b"), "edges")
    labels = written(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                     .withColumn("root", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = written(both.groupBy(F.col("a").alias("old")).agg(F.least("old", F.min("b")).alias("new")), "hooks")
        while True:
            ahead = hook.select(F.col("old").alias("new"), F.col("new").alias("next"))
            step = written(hook.join(ahead, "new").select(
                "old", F.col("next").alias("new"), (F.col("next") != F.col("new")).alias("moved")), "hooks")
            hook = step.select("old", "new")
            if step.filter("moved").isEmpty():
                break
        labels = written(labels.join(hook, labels["root"] == hook["old"], "left").select(
            "node", F.coalesce("new", "root").alias("root")), "labels")
        half = written(edges.join(hook, edges["a"] == hook["old"]).select(F.col("new").alias("a"), "b"), "edges")
        edges = written(half.join(hook, half["b"] == hook["old"]).select(
            F.least("a", "new").alias("a"), F.greatest("a", "new").alias("b")).filter("a <> b").distinct(), "edges")
    return labels
