"""What finding triangles keeps on disk: one phase's shuffle at a time, and not the result."""

import time

import pytest
from pyspark.sql import functions as F

import reference_results as py
from weftgraph import Graph, corner_edges, lcc, triangle_count, triangles
from weftgraph.operators import runtime
from weftgraph.operators.triangles import closed

EDGES = [(i, j, 1.0) for i in range(12) for j in range(12) if (i * j) % 3 == 1 or (i + j) % 5 == 2]


def shuffles(spark):
    """Numbers of the shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    names = [line.rsplit("/", 1)[-1] for line in files.splitlines()]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def graph_of(spark, directed):
    rows = spark.createDataFrame(EDGES, "src long, dst long, weight double").repartition(3)
    pairs = rows.groupBy("src", "dst").agg(F.min("weight").alias("weight"))
    return Graph.from_edges(pairs, directed)


@pytest.mark.parametrize("directed", [True, False])
@pytest.mark.parametrize("every_vertex", [True, False])
def test_shuffles_of_earlier_phases_are_gone_when_lists_meet(spark, monkeypatch, directed, every_vertex):
    cuts = []
    monkeypatch.setattr(runtime, "cut", lambda frame, cut=runtime.cut: cuts.append(cut(frame)) or cuts[-1])
    before = shuffles(spark)
    with closed(graph_of(spark, directed), every_vertex=every_vertex) as found:
        for _ in range(50):
            if not shuffles(spark) - before:
                break
            time.sleep(0.2)
        assert not shuffles(spark) - before
        assert found.common.count() > 0
    left = [f.columns for f in cuts if runtime.exists(spark, f._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())]
    # Edges and pairs are deleted once what comes of them is written.
    assert ["a", "b"] not in [c[:2] for c in left] and ["src", "dst"] not in left and ["u", "list"] in left


@pytest.mark.parametrize("directed", [True, False])
def test_results_larger_than_the_graph_are_not_written(spark, monkeypatch, directed):
    graph = graph_of(spark, directed)
    listed = EDGES if directed else py.undirected(EDGES)
    cuts = []
    monkeypatch.setattr(runtime, "cut", lambda frame, cut=runtime.cut: cuts.append(cut(frame)) or cuts[-1])
    first, second = triangles(graph), corner_edges(graph)
    assert [c.columns for c in cuts if c.columns in (["a", "b", "c"], ["id", "src", "dst"])] == []
    # Used twice, under the session's own settings, and joined.
    for _ in range(2):
        assert {tuple(r) for r in first.collect()} == py.triangles(listed)
        assert sorted(tuple(r) for r in second.collect()) == sorted(py.corner_edges(listed))
    assert first.join(first.groupBy("a").count(), "a").count() == len(py.triangles(listed))


@pytest.mark.parametrize("how", ["derived", "cached", "written", "listed", "loops only"])
@pytest.mark.parametrize("directed", [True, False])
def test_vertices_and_edges_of_any_origin(spark, how, directed):
    """A graph's vertices are its own, whether they come from its edges or a table; loops have an end as well."""
    edges = EDGES + [(40, 40, 1.0), (41, 0, 1.0)] if how != "loops only" else [(7, 7, 1.0)]
    frame = spark.createDataFrame(edges, "src long, dst long, weight double")
    graph = Graph.from_edges(frame, directed)
    if how == "listed":
        graph = Graph.from_tables(spark.range(95, 97), frame, directed)
    if how == "cached":
        graph.edges.persist()
    if how == "written":
        graph = graph.checkpoint()
    vertices = {v for e in edges for v in e[:2]} | ({95, 96} if how == "listed" else set())
    rows = edges if directed else py.undirected(edges)
    for _ in range(2):
        assert {r[0]: r[1] for r in lcc(graph).collect()} == pytest.approx(py.lcc(vertices, rows), abs=1e-12)
        assert {tuple(r) for r in triangles(graph).collect()} == py.triangles(rows)
    assert triangle_count(graph).count() == len({v for t in py.triangles(rows) for v in t})
    assert sorted(r.id for r in graph.vertices.collect()) == sorted(vertices)
    graph.edges.unpersist()
