"""Communities by synchronous label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from weftgraph.graph import Graph
from weftgraph.operators.gather import Received, received
from weftgraph.operators.runtime import cut, discard


def cdlp(graph: Graph, iterations: int) -> DataFrame:
    """``(id, label)`` after ``iterations`` rounds, starting from each vertex's own id.

    In a round every vertex takes the label most frequent among its neighbours, the smallest of equals.
    In a directed graph a neighbour linked both ways counts twice. A vertex without neighbours keeps
    its label. Rounds that could change nothing any more are left out.
    """
    with received(graph, undirected=True) as edges:
        first = F.col("dst").alias("id")
        state = cut(edges.placed(edges.per_receiver.select(first, F.col("dst").alias("label"))))
        edges.release()
        for _ in range(iterations):
            watch = Observation()
            rows = state.select("block", "id", "label")
            before, state = state, cut(_round(edges, rows), watch, changed=F.count_if("_changed"))
            discard(before)
            if not watch.get["changed"]:
                break
        return state.select("id", "label")


def _round(edges: Received, state: DataFrame) -> DataFrame:
    found, hot = edges.most_frequent(state), edges.met_hot(state)
    label = F.col("label")
    if hot is not None:
        # Of a vertex with very many edges each block counts its own, and one best label comes of the sums.
        counted = hot.groupBy("dst", "label").agg(F.count(F.lit(1)).alias("times"))
        best = F.min_by("label", F.struct(-F.col("times"), "label"))
        found = found.join(F.broadcast(counted.groupBy(F.col("dst").alias("id")).agg(best.alias("_hot"))), "id", "left")
        label = F.coalesce("_hot", "label")
    return edges.placed(found.select("id", label.alias("label"), (label != F.col("was")).alias("_changed")))
