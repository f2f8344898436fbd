"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node of the component.

    In each round every node joins its neighbour - or itself - of the least hash, and the edges are drawn between what
    the nodes have joined. A fixed share of the nodes goes in each round whatever the numbering, so the rounds are
    logarithmic and the edges shrink. Hashes, not numbers, are compared: numbered chains would lose one node a round.
    Edges with a null end are ignored.
    """
    edges = edges.select(F.col("a"), F.col("b")).filter("a != b")
    graph, joined, turn = saved(edges.union(edges.select("b", "a")).distinct()), [], 0
    while graph.limit(1).count():
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.col(c), F.lit(t)), F.col(c).alias("n"))
        step = graph.groupBy("a").agg(F.min(rank("b")).alias("low"))
        step = saved(step.select(F.col("a").alias("node"), F.least(F.col("low"), rank("a"))["n"].alias("to")))
        joined.append(step)
        left, right = step.toDF("a", "a_to"), step.toDF("b", "b_to")
        graph = saved(graph.join(left, "a").join(right, "b").filter("a_to != b_to")
                      .select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct())
        turn += 1
    if not joined:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    label = joined[-1]
    for step in reversed(joined[:-1]):
        label = saved(step.join(label.toDF("to", "end"), "to", "left").select("node", F.coalesce("end", "to").alias("to")))
    least = label.groupBy("to").agg(F.min("node").alias("component"))
    return label.join(least, "to").select("node", "component")
