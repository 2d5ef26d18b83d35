"""Connected components of an edge table, by joins whose results are written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import stored


def closed(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the (a, b) edges: the smallest node it is connected with.

    Every round each node takes the smallest label among its neighbours' and its own, then the
    label of that label, so distances halve. Edges between nodes of one label are dropped, and
    the others are carried on between labels, so the edge table shrinks. Rounds go on until
    no edge joins two labels.
    """
    pairs = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "edges")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    labels = stored(nodes.select("node", F.col("node").alias("label")), "labels")
    while not pairs.isEmpty():
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        parent = _jumped(stored(parent, "parents"))
        labels = stored(labels.join(parent, labels["label"] == parent["a"], "left")
                        .select("node", F.coalesce("p", "label").alias("label")), "labels")
        left, right = parent.select("a", F.col("p").alias("pa")), parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        carried = pairs.join(left, "a").join(right, "b").where("pa != pb")
        pairs = stored(carried.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    return labels


def _jumped(parent: DataFrame) -> DataFrame:
    """Parents followed to the root of each tree, doubling the step every round."""
    while True:
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("next"))
        stepped = stored(parent.join(up, "p", "left").select("a", F.coalesce("next", "p").alias("p"), (F.coalesce("next", "p") != F.col("p")).alias("moved")), "parents")
        parent = stepped.select("a", "p")
        if stepped.where("moved").isEmpty():
            return parent
