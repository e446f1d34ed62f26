"""Connected components by contraction, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of ``edges`` (a, b: long); the label is a node of the component.

    Each round joins every node to its smallest neighbour, follows that pointer twice, and goes on
    with the edges between what is left. Pointers lead to smaller nodes, so they cannot form a
    circle, and a node that is no local minimum is gone after its round. Tables are written between
    rounds, which cuts lineage. An empty table gives an empty result.
    """
    edges = materialise(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.least("a", F.min("b")).alias("p"))
        up = parents.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        parents = materialise(parents.join(up, "p").select("a", F.col("pp").alias("p")), "parents")
        if labels is None:
            labels = parents.select(F.col("a").alias("node"), F.col("p").alias("label"))
        else:
            step = parents.select(F.col("a").alias("label"), "p")
            labels = labels.join(step, "label", "left")
            labels = labels.select("node", F.coalesce("p", "label").alias("label"))
            labels = materialise(labels, "labels")
        to = parents.select(F.col("a").alias("b"), F.col("p").alias("q"))
        edges = edges.join(parents, "a").join(to, "b").where("p <> q")
        edges = edges.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
        edges = materialise(edges.distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
