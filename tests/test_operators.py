"""Degrees, transforms, message passing, files and plans."""

import pytest
from pyspark.sql import functions as F

import weftgraph as wg
from weftgraph import Graph, propagate
from weftgraph.functions import most_frequent, reduced_by


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def graph(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (2, 3), (3, 3)], "src long, dst long")
    return Graph.from_tables(spark.createDataFrame([(4,)], "id long"), edges)


def test_degrees(graph):
    assert rows(wg.out_degree(graph)) == [(1, 2), (2, 2), (3, 1), (4, 0)]
    assert rows(wg.out_degree_nonzero(graph)) == [(1, 2), (2, 2), (3, 1)]
    assert rows(wg.in_degree(graph)) == [(1, 1), (2, 2), (3, 2), (4, 0)]
    assert rows(wg.total_degree(graph)) == [(1, 3), (2, 4), (3, 3), (4, 0)]
    assert rows(wg.neighbour_count(graph)) == [(1, 1), (2, 2), (3, 2), (4, 0)]
    assert rows(wg.dangling_vertices(graph)) == [(4,)]
    assert rows(wg.dangling_count(graph)) == [(1,)]


def test_transition_probabilities(graph):
    assert rows(wg.transition_probabilities(graph)) == [(1, 2, 0.5), (1, 2, 0.5), (2, 1, 0.5), (2, 3, 0.5), (3, 3, 1.0)]


def test_transforms(graph):
    assert rows(graph.symmetrise().edges) == sorted(2 * [(1, 2), (2, 1), (3, 3)] + [(1, 2), (2, 1), (2, 3), (3, 2)])
    assert rows(graph.distinct_edges().edges) == [(1, 2), (2, 1), (2, 3), (3, 3)]
    weighted = graph.map_edges(weight=F.col("src") * 1.0)
    assert weighted.weighted and not weighted.unweighted().weighted
    kept = weighted.map_edges(note=F.lit("n")).distinct_edges().edges
    assert kept.columns == ["src", "dst", "weight", "note"] and kept.count() == 4
    assert rows(weighted.distinct_edges().edges) == [(1, 2, 1.0), (2, 1, 2.0), (2, 3, 2.0), (3, 3, 3.0)]
    assert rows(graph.map_vertices(label=F.col("id") * 2).vertices) == [(1, 2), (2, 4), (3, 6), (4, 8)]


def test_propagate_with_all_its_arguments(graph):
    state = graph.vertices.select("id", F.lit(1.0).alias("mass"), F.lit(0).cast("long").alias("seen"))
    result = propagate(
        graph,
        state,
        message=lambda step: F.col("mass") * step.number,
        combine=reduced_by(F.sum),
        update=lambda step: {
            "mass": F.coalesce("msg", F.lit(0.0)) + step.totals["all"],
            "seen": F.col("seen") + step.number,
        },
        totals={"all": F.sum("mass")},
        max_iterations=2,
    )
    # Round 1: in-degrees plus 4; round 2: twice the neighbours' masses plus their total of 21.
    assert rows(result) == [(1, 33.0, 3), (2, 41.0, 3), (3, 45.0, 3), (4, 21.0, 3)]


def test_propagate_both_ways_with_most_frequent(graph):
    state = graph.vertices.select("id", F.col("id").alias("label"))
    new = {"label": F.coalesce("msg", "label")}
    result = propagate(graph, state, F.col("label"), most_frequent, new, direction="all", max_iterations=1)
    assert rows(result) == [(1, 2), (2, 1), (3, 3), (4, 4)]


def test_propagate_over_weights(spark):
    edges = spark.createDataFrame([(1, 2, 5.0), (2, 3, 2.0), (1, 3, 4.0)], "src long, dst long, weight double")
    graph = Graph.from_edges(edges)
    widest = propagate(
        graph,
        graph.vertices.select("id", F.when(F.col("id") == 1, F.lit(99.0)).otherwise(0.0).alias("width")),
        message=F.least("width", "weight"),
        combine=reduced_by(F.max),
        update={"width": F.greatest("width", "msg")},
        senders=F.col("width") > 0,
    )
    assert rows(widest) == [(1, 99.0), (2, 5.0), (3, 4.0)]


def test_propagate_runs_all_rounds_where_they_differ(spark):
    graph = Graph.from_edges(spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long"))
    state = graph.vertices.select("id", F.lit(0).alias("x"))
    message = lambda step: F.lit(1 if step.number == 3 else 0)
    update = {"x": F.greatest("x", "msg")}
    assert rows(propagate(graph, state, message, reduced_by(F.max), update, max_iterations=3)) == [(1, 1), (2, 1)]
    with pytest.raises(ValueError, match="max_iterations"):
        propagate(graph, state, message, reduced_by(F.max), update)
    with pytest.raises(ValueError, match="max_iterations"):
        propagate(graph, state, F.lit(0), reduced_by(F.max), update, totals={"x": F.sum("x")})


def test_propagate_refuses_wrong_arguments(graph):
    with pytest.raises(ValueError, match="direction"):
        propagate(graph, graph.vertices, F.col("id"), reduced_by(F.min), {}, direction="in")
    with pytest.raises(ValueError, match="state columns"):
        propagate(graph, graph.vertices.withColumn("msg", F.lit(1)), F.col("id"), reduced_by(F.min), {})


@pytest.mark.parametrize("weighted", [True, False])
def test_files(spark, tmp_path, weighted):
    edges = [(1, 2, 0.5), (2, 3, 1.5)] if weighted else [(1, 2), (2, 3)]
    schema = "src long, dst long" + (", weight double" if weighted else "")
    graph = Graph.from_tables(spark.createDataFrame([(9,)], "id long"), spark.createDataFrame(edges, schema))
    wg.write_edge_list(graph, f"{tmp_path}/g.e")
    wg.write_vertex_list(graph, f"{tmp_path}/g.v")
    lines = sorted(r.value for r in spark.read.text(f"{tmp_path}/g.e").collect())
    assert lines == (["1 2 0.5", "2 3 1.5"] if weighted else ["1 2", "2 3"])
    again = wg.read_graph(spark, f"{tmp_path}/g.e", f"{tmp_path}/g.v", weighted=weighted)
    assert rows(again.edges) == edges and rows(again.vertices) == [(1,), (2,), (3,), (9,)]
    assert rows(wg.read_graph(spark, f"{tmp_path}/g.e", weighted=weighted).vertices) == [(1,), (2,), (3,)]
    wg.write_result(wg.bfs(again, 1), f"{tmp_path}/out")
    lines = sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect())
    assert lines == ["1 0", "2 1", "3 2", "9 9223372036854775807"]
    wg.write_result(wg.bfs(again, 1), f"{tmp_path}/out", format="parquet", mode="overwrite")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_malformed_lines_fail(spark, tmp_path):
    (tmp_path / "bad.e").write_text("1 2\n3 x\n")
    with pytest.raises(Exception):
        wg.read_edge_list(spark, f"{tmp_path}/bad.e").collect()
