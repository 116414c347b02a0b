"""Local clustering coefficient."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftgraph.graph import Graph
from weftgraph.operators import runtime
from weftgraph.operators.triangles import closed, linked_neighbours


def lcc(graph: Graph) -> DataFrame:
    """``(id, coefficient)``: edges among a vertex's neighbours over the edges there could be.

    Neighbours are the distinct vertices linked in either direction; each direction between two of them
    is an edge of its own. Loops and duplicate edges are ignored. Vertices with fewer than two
    neighbours get 0. In an undirected graph both directions exist, which is the usual
    2 * triangles / (d * (d - 1)).
    """
    with closed(graph, ("mutual",) if graph.directed else (), every_vertex=True) as found:
        d = F.col("degree")
        share = F.coalesce("links", F.lit(0)) / (d * (d - 1))
        return runtime.cut(
            found.vertices.join(found.degrees, "id", "left")
            .join(linked_neighbours(found, graph.directed), "id", "left")
            .select("id", F.when(d > 1, share).otherwise(F.lit(0.0)).alias("coefficient"))
        )
