"""Distances from one source: by hops, and by edge weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftgraph.functions.combine import reduced_by
from weftgraph.graph import Graph
from weftgraph.operators.blocks import blocked
from weftgraph.operators.layout import arranged
from weftgraph.operators.propagate import iterate
from weftgraph.operators.relax import Work, distances
from weftgraph.operators.runtime import cut, partition_count

# Fixed values standing for "not reached" in results.
UNREACHED_HOPS = 9223372036854775807
UNREACHED_DISTANCE = float("inf")


FEW, PATIENCE = 0.01, 8
"""After so many rounds in which less than that share of the vertices changed, rounds go by blocks."""


def bfs(
    graph: Graph,
    source: int,
    *,
    max_iterations: int | None = None,
    unreachable: int | None = UNREACHED_HOPS,
    work: Work | None = None,
) -> DataFrame:
    """``(id, hops)``: edges on a shortest path from ``source`` along the edge direction.

    All vertices are listed; those out of reach, or further than ``max_iterations``, get ``unreachable``. Where round after
    round changes little, rounds follow the blocks that paths lead through, not their edges; ``work`` is told of those.
    """
    found = F.when(F.col("id") == F.lit(source), F.lit(0).cast("long"))
    rules = {"message": F.col("hops") + 1, "update": {"hops": F.least("hops", "msg")}}
    return _nearest(graph, "hops", found, rules, max_iterations, max_iterations, unreachable, work)


def sssp(
    graph: Graph,
    source: int,
    *,
    max_iterations: int | None = None,
    unreachable: float | None = UNREACHED_DISTANCE,
    work: Work | None = None,
) -> DataFrame:
    """``(id, distance)``: least sum of weights over paths from ``source`` along the edge direction.

    With ``max_iterations`` paths have at most that many edges. Negative weights need it, since a cycle of negative weight has no
    least sum. Without it, rounds go by blocks where round after round changes little; ``work`` is told of those.
    """
    if not graph.weighted:
        raise ValueError("shortest paths need a weighted graph; name the column with weight=")
    found = F.when(F.col("id") == F.lit(source), F.lit(0.0))
    # An edge of infinite or undefined weight leads nowhere; NaN sorts above infinity.
    finite = F.when(F.col("msg") < F.lit(UNREACHED_DISTANCE), F.col("msg"))
    rules = {"message": F.col("distance") + F.col("weight"), "update": {"distance": F.least("distance", finite)}}
    return _nearest(graph, "distance", found, rules, max_iterations, None, unreachable, work)


def _nearest(
    graph: Graph, name: str, found: Column, rules: dict, rounds: int | None, limit: int | None, unreachable: float | None, work: Work | None
) -> DataFrame:
    """Rounds of one edge each, and of one block each once little changes in them.

    ``rounds`` bounds the edges of a path. Blocks can keep to that only where it bounds the distance too, as ``limit``.
    """
    spark = graph.vertices.sparkSession
    weighted = name == "distance"
    quiet = 0
    with graph.held():
        vertices = graph.vertices.count()

        def pause(changed: int) -> bool:
            nonlocal quiet
            quiet = quiet + 1 if changed < FEW * vertices else 0
            return quiet > PATIENCE and (rounds is None or limit is not None)

        with arranged(graph, weighted=weighted) as layout:
            if weighted and rounds is None and layout.least_weight is not None and layout.least_weight < 0:
                raise ValueError(f"negative edge weight {layout.least_weight}; set max_iterations to allow it")
            state = graph.vertices.select("id", found.alias(name))
            state = iterate(
                layout,
                state,
                rules["message"],
                reduced_by(F.min),
                rules["update"],
                F.col(name).isNotNull(),
                max_iterations=rounds,
                pause=pause,
                keeps=True,
            )
        kind = state.schema[name].dataType
        missing = F.lit(unreachable).cast(kind)
        if "_changed" not in state.columns:
            return state.select("id", F.coalesce(name, missing).alias(name))
        reached = state.where(F.col(name).isNotNull()).select("id", F.col(name).cast("double").alias("value"), F.col("_changed").alias("fresh"))
        with blocked(graph, weighted=weighted) as blocks:
            nearest = distances(blocks, reached, limit=limit, work=work)
            # Vertices may be far more than edges, so by their number.
            every, nearest = (x.repartition(partition_count(spark, vertices), "id") for x in (graph.vertices.select("id"), nearest))
            value = F.coalesce(F.col("value").cast(kind), missing)
            return cut(every.join(nearest, "id", "left").select("id", value.alias(name)))
