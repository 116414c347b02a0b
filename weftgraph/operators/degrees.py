"""Degree tables ``(id, degree)`` and what follows from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from weftgraph.graph import Graph
from weftgraph.operators import runtime, skew
from weftgraph.operators.runtime import cut


def _counted(ends: DataFrame) -> DataFrame:
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def _for_all(graph: Graph, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Counts of edge ends for every vertex; the edges are derived once for both."""
    with graph.ends_held() as held:
        counts = count(held.edges)
        return cut(held.vertices.select("id").join(counts, "id", "left").na.fill(0, ["degree"]))


def out_degree_nonzero(graph: Graph) -> DataFrame:
    """Number of out-edges, for vertices that have any."""
    return _counted(graph.edges.select(F.col("src").alias("id")))


def out_degree(graph: Graph) -> DataFrame:
    """Number of out-edges of every vertex."""
    return _for_all(graph, lambda edges: _counted(edges.select(F.col("src").alias("id"))))


def in_degree(graph: Graph) -> DataFrame:
    """Number of in-edges of every vertex."""
    return _for_all(graph, lambda edges: _counted(edges.select(F.col("dst").alias("id"))))


def total_degree(graph: Graph) -> DataFrame:
    """Number of edge ends at every vertex, in and out; a loop has both."""
    return _for_all(graph, lambda edges: _counted(edges.select(F.explode(F.array("src", "dst")).alias("id"))))


def neighbour_count(graph: Graph) -> DataFrame:
    """Number of distinct vertices linked to every vertex in either direction, itself included by a loop."""

    def count(edges: DataFrame) -> DataFrame:
        # Pairs are made unique while each is still one row; a loop has one end.
        low, high = F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high")
        rising = edges if graph.directed else edges.where(F.col("src") <= F.col("dst"))
        ends = F.array_distinct(F.array("low", "high"))
        return _counted(rising.select(low, high).distinct().select(F.explode(ends).alias("id")))

    return _for_all(graph, count)


def dangling_vertices(graph: Graph) -> DataFrame:
    """Ids of the vertices without out-edges."""
    return graph.vertices.select("id").join(out_degree_nonzero(graph), "id", "left_anti")


def dangling_count(graph: Graph) -> DataFrame:
    """One row: the number of vertices without out-edges."""
    with graph.ends_held() as held:
        return cut(dangling_vertices(held).agg(F.count(F.lit(1)).alias("dangling")))


def hot_vertices(counts: DataFrame, key: str) -> DataFrame | None:
    """The ids in ``counts(id, degree)`` whose rows need splitting, as ``(key, _salts)``; None if there are none."""
    total, most = counts.agg(F.sum("degree"), F.max("degree")).first()
    if not total:
        return None
    limit = skew.hot_threshold(total, runtime.partition_count(counts.sparkSession, total))
    if most <= limit:
        return None
    return skew.hot_keys(counts.withColumnRenamed("id", key), key, "degree", limit)


def transition_probabilities(graph: Graph) -> DataFrame:
    """``(src, dst, probability)``: each edge with one over the out-degree of its source."""
    with graph.held():
        degrees = cut(out_degree_nonzero(graph))
        hot = hot_vertices(degrees, "src")
        table = degrees.select(F.col("id").alias("src"), (F.lit(1.0) / F.col("degree")).alias("probability"))
        edges = graph.edges.select("src", "dst")
        found = skew.keyed_join(edges, table, "src", None if hot is None else cut(hot))
        return cut(found.select("src", "dst", "probability"))
