"""Connected components of an undirected graph, by least labels and pointer jumping.

Only minima per node are aggregated, partly before the shuffle, so a node with very many
neighbours is no group that anyone collects. Every round is written to the shared storage, which
keeps plans short and survives lost executors; a path of length L takes about log2(L) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the least node of its component."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    for _ in range(MOST_ROUNDS):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        step = stored(step)  # alone in its stage the join on a label, which a large component shares, can be split
        jump = step.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = step.hint("merge").join(jump, step["label"] == jump["via"], "left").select("node", "old", F.least("label", "far").alias("label"))
        new = stored(new)
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
    raise RuntimeError("the components did not settle")
