"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import Staging


def _step(edges: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """``column`` of the edges moved to its parent."""
    up = parents.select(F.col("hi").alias(column), F.col("lo").alias("__up"))
    return edges.join(up, column, "left").withColumn(column, F.coalesce("__up", column)).drop("__up")


def components(links: DataFrame, stage: Staging) -> DataFrame:
    """(node, label) of every node that has a link; ``label`` is the same within a component.

    Each round hooks every node to its least neighbour, halves the paths twice and contracts the links,
    so their number falls by a constant factor or more. Nothing is gathered by group, and links between
    nodes of one component vanish. Labels are names of nodes.
    """
    ends = [F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")]
    edges = stage.table(links.select(*ends).where("hi != lo").distinct(), "links")
    labels = edges.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
    labels = labels.withColumn("label", F.col("node"))
    while not edges.isEmpty():
        parents = edges.groupBy("hi").agg(F.min("lo").alias("lo"))
        for part in ("parents", "grandparents"):
            parents = stage.table(parents, part)
            parents = _step(parents, parents, "lo")
        parents = stage.table(parents, "roots")
        labels = stage.table(_step(labels, parents, "label"), "labels")
        moved = _step(_step(edges, parents, "hi"), parents, "lo")
        edges = stage.table(
            moved.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"))
            .where("hi != lo")
            .distinct(),
            "links",
        )
    return labels
