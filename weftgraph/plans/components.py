"""Weakly connected components, named by their smallest vertex id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from weftgraph.functions.combine import reduced_by
from weftgraph.graph import Graph
from weftgraph.operators import skew
from weftgraph.operators.layout import Layout, arranged
from weftgraph.operators.propagate import iterate
from weftgraph.operators.runtime import cut, discard


def wcc(graph: Graph, *, max_iterations: int | None = None) -> DataFrame:
    """``(id, component)``: the smallest id in the vertex's component, directions ignored.

    By default labels also jump along labels, which needs about log(V) rounds whatever the diameter.
    With ``max_iterations`` the smallest id travels one edge per round for at most that many rounds, so
    components of a greater diameter stay unfinished.
    """
    with arranged(graph, undirected=True) as layout:
        if max_iterations is not None:
            return iterate(
                layout,
                graph.vertices.select("id", F.col("id").alias("component")),
                message=F.col("component"),
                combine=reduced_by(F.min),
                update={"component": F.least("component", "msg")},
                senders=F.lit(True),
                max_iterations=max_iterations,
                keeps=True,
            )
        return _hook_and_jump(layout, graph.vertices)


def _hook_and_jump(layout: Layout, vertices: DataFrame) -> DataFrame:
    """Rounds of two steps over ``(id, component)``, where a label is the id of a vertex with no larger one.

    Hook: the smallest label of a vertex's neighbours goes to the vertex and to the vertex its label
    names. Jump: each vertex takes the label of the vertex its label names. When no neighbour has a
    smaller label, labels are equal along every edge and the smallest id has kept its own.
    """
    state = cut(
        vertices.select("id", F.col("id").alias("component"), F.lit(True).alias("_changed"))
        .repartition(layout.partitions, "id")
        .sortWithinPartitions("id")
    )
    layout.release()
    while True:
        watch = Observation()
        before, state = state, cut(_hook(layout, state), watch, changed=F.count_if("_changed"), vertices=F.count(F.lit(1)))
        discard(before)
        seen = watch.get
        if not seen["changed"]:
            return state.drop("_changed")
        before, state = state, cut(_jump(state, seen["vertices"], layout.partitions))
        discard(before)


def _lower(state: DataFrame, offer: Column, changed: Column) -> DataFrame:
    better = F.coalesce(offer < F.col("component"), F.lit(False))
    return state.select("id", F.least("component", offer).alias("component"), (changed | better).alias("_changed"))


def _hook(layout: Layout, state: DataFrame) -> DataFrame:
    smallest = reduced_by(F.min)
    sent = layout.send(state.where("_changed").select(F.col("id").alias("src"), "component"), F.col("component"))
    near = state.join(smallest(sent), "id", "left")
    better = near.where(F.col("msg") < F.col("component"))
    # Pre-aggregated per task: a label held by most vertices costs one row per task.
    named = better.groupBy(F.col("component").alias("id")).agg(F.min("msg").alias("named"))
    return _lower(near.join(named, "id", "left"), F.least("msg", "named"), F.lit(False))


def _jump(state: DataFrame, vertices: int, partitions: int) -> DataFrame:
    """Labels looked up as ids. Vertices sharing one label may be most of the graph, so those of such a label
    are split into parts; a label naming its own holder's root needs no lookup.
    """
    labels = state.select(F.col("id").alias("component"), F.col("component").alias("jumped"))
    open_rows = state.where(F.col("id") != F.col("component")).select("id", "component")
    limit = skew.hot_threshold(vertices, partitions)
    hot = None
    if vertices > limit:
        counts = open_rows.groupBy("component").agg(F.count(F.lit(1)).alias("rows"))
        hot = cut(skew.hot_keys(counts, "component", "rows", limit))
    found = skew.keyed_join(open_rows, labels, "component", hot)
    moved = found.where(F.col("jumped") < F.col("component")).select("id", "jumped")
    return _lower(state.join(moved, "id", "left"), F.col("jumped"), F.col("_changed"))
