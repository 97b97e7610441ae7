"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) to (node, label): every node of an edge with the smallest node of its component.

    Each round moves every node to its smallest neighbour and contracts the graph. Nodes are hashes, so each
    round leaves about the local minima, and the number of rounds grows with the logarithm of the nodes. Only
    grouped minima and joins on nodes are used; a node with very many edges is split by adaptive execution.
    """
    both = edges.where("a <> b").select("a", "b")
    graph = scratch.keep(both.union(both.select("b", "a")).distinct(), "edges")
    labels = scratch.keep(graph.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), "labels")
    while not graph.isEmpty():
        moves = scratch.keep(graph.groupBy("a").agg(F.min(F.least("a", "b")).alias("to")), "moves")
        moved = (
            graph.join(moves, "a").select(F.col("to").alias("a2"), F.col("b"))
            .join(moves.withColumnsRenamed({"a": "b", "to": "b2"}), "b").where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        )
        new_labels = labels.join(moves.withColumnRenamed("a", "label"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label"))
        old = [graph, labels, moves]
        graph, labels = scratch.keep(moved.distinct(), "edges"), scratch.keep(new_labels, "labels")
        scratch.drop(*old)
    scratch.drop(graph)
    return labels
