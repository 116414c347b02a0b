"""The further cases of FIXTURES.md part 3, and what the constructors promise."""

import pytest

from weftgraph import Graph, bfs, cdlp, lcc, pagerank, sssp, wcc
from weftgraph.sources.tables import busiest_source
from weftgraph.plans.distances import UNREACHED_DISTANCE, UNREACHED_HOPS


def values(result):
    return {row[0]: row[1] for row in result.collect()}


def graph_of(spark, edges, vertices=None, directed=True):
    weighted = bool(edges) and len(edges[0]) == 3
    frame = spark.createDataFrame(edges, "src long, dst long" + (", weight double" if weighted else ""))
    if vertices is None:
        return Graph.from_edges(frame, directed)
    return Graph.from_tables(spark.createDataFrame([(v,) for v in vertices], "id long"), frame, directed)


def test_absent_source_reaches_nothing(spark):
    graph = graph_of(spark, [(1, 2, 1.0)])
    assert values(bfs(graph, 77)) == {1: UNREACHED_HOPS, 2: UNREACHED_HOPS}
    assert values(sssp(graph, 77)) == {1: UNREACHED_DISTANCE, 2: UNREACHED_DISTANCE}
    assert values(bfs(graph, 2, unreachable=None)) == {1: None, 2: 0}


def test_no_edges(spark):
    graph = graph_of(spark, [], [1, 2, 3])
    assert values(bfs(graph, 2)) == {1: UNREACHED_HOPS, 2: 0, 3: UNREACHED_HOPS}
    assert values(wcc(graph)) == values(cdlp(graph, 3)) == {1: 1, 2: 2, 3: 3}
    assert values(pagerank(graph, 5)) == pytest.approx({v: 1 / 3 for v in (1, 2, 3)})
    assert values(lcc(graph)) == {1: 0.0, 2: 0.0, 3: 0.0}


def test_no_vertices(spark):
    graph = graph_of(spark, [], [])
    for result in (bfs(graph, 1), wcc(graph), cdlp(graph, 2), pagerank(graph, 3), lcc(graph)):
        assert result.count() == 0


def test_loops_and_parallel_edges(spark):
    graph = graph_of(spark, [(1, 1), (1, 2), (1, 2), (2, 3), (3, 1)])
    ranks = values(pagerank(graph, 1, 1.0))
    assert ranks == pytest.approx({1: 1 / 9 + 1 / 3, 2: 2 / 9, 3: 1 / 3})
    assert values(lcc(graph)) == pytest.approx({1: 0.5, 2: 0.5, 3: 0.5})


def test_undirected_listing_once_or_twice_is_the_same(spark):
    once = graph_of(spark, [(1, 2, 3.0), (2, 3, 1.0), (4, 4, 1.0)], directed=False)
    twice = graph_of(spark, [(1, 2, 5.0), (2, 1, 3.0), (2, 3, 1.0), (3, 2, 1.0), (4, 4, 1.0)], directed=False)
    rows = sorted(map(tuple, once.edges.collect()))
    assert rows == sorted(map(tuple, twice.edges.collect()))
    assert rows == [(1, 2, 3.0), (2, 1, 3.0), (2, 3, 1.0), (3, 2, 1.0), (4, 4, 1.0)]


def test_negative_weights_need_a_limit(spark):
    graph = graph_of(spark, [(1, 2, -1.0), (2, 1, -1.0)])
    with pytest.raises(ValueError, match="negative"):
        sssp(graph, 1)
    assert values(sssp(graph, 1, max_iterations=3)) == {1: -2.0, 2: -3.0}


def test_infinite_and_undefined_weights_lead_nowhere(spark):
    inf, nan = float("inf"), float("nan")
    graph = graph_of(spark, [(1, 2, inf), (1, 3, nan), (3, 4, 1.0), (1, 5, 2.0)])
    assert values(sssp(graph, 1, unreachable=-1.0)) == {1: 0.0, 2: -1.0, 3: -1.0, 4: -1.0, 5: 2.0}


def test_distances_need_weights(spark):
    with pytest.raises(ValueError, match="weighted"):
        sssp(graph_of(spark, [(1, 2)]), 1)


def test_long_chain_is_reached_unless_limited(spark):
    graph = graph_of(spark, [(i, i + 1) for i in range(25)])
    assert values(bfs(graph, 0)) == {i: i for i in range(26)}
    assert values(bfs(graph, 0, max_iterations=10)) == {i: i if i <= 10 else UNREACHED_HOPS for i in range(26)}
    assert values(wcc(graph)) == {i: 0 for i in range(26)}
    assert values(wcc(graph, max_iterations=10)) == {i: max(0, i - 10) for i in range(26)}


def test_two_cycle_swaps_labels(spark):
    graph = graph_of(spark, [(1, 2), (2, 1)])
    assert values(cdlp(graph, 1)) == values(cdlp(graph, 3)) == {1: 2, 2: 1}
    assert values(cdlp(graph, 2)) == {1: 1, 2: 2}


def test_edge_ends_are_added_to_the_vertices(spark):
    graph = graph_of(spark, [(1, 2)], [2, 9])
    assert sorted(r.id for r in graph.vertices.collect()) == [1, 2, 9]


def test_any_columns_can_be_named(spark):
    vertices = spark.createDataFrame([("5",)], "name string")
    edges = spark.createDataFrame([(1, 2, 7)], "a int, b int, cost int")
    graph = Graph.from_tables(vertices, edges, id="name", src="a", dst="b", weight="cost")
    assert values(sssp(graph, 1)) == {1: 0.0, 2: 7.0, 5: UNREACHED_DISTANCE}
    with pytest.raises(ValueError, match="numeric"):
        Graph.from_edges(spark.createDataFrame([(1, 2, "x")], "src long, dst long, weight string"))


def test_missing_ids_and_weights_fail(spark):
    with pytest.raises(Exception, match="null vertex id"):
        Graph.from_edges(spark.createDataFrame([(1, None)], "src long, dst long")).edges.collect()
    with pytest.raises(Exception, match="null edge weight"):
        frame = spark.createDataFrame([(1, 2, None)], "src long, dst long, weight double")
        Graph.from_edges(frame).edges.collect()


def test_fractional_ids_fail(spark):
    whole = spark.createDataFrame([(1.0, 2.0)], "src double, dst double")
    assert [tuple(r) for r in Graph.from_edges(whole).edges.collect()] == [(1, 2)]
    texts = spark.createDataFrame([("1", " 2")], "src string, dst string")
    assert [tuple(r) for r in Graph.from_edges(texts).edges.collect()] == [(1, 2)]
    for kind, wrong in (("double", 1.2), ("double", float("nan")), ("double", 1e30), ("string", "1.7"), ("string", "x")):
        with pytest.raises(Exception, match="no whole number"):
            Graph.from_edges(spark.createDataFrame([(wrong, wrong)], f"src {kind}, dst {kind}")).edges.collect()
    with pytest.raises(ValueError, match="whole numbers"):
        Graph.from_edges(spark.createDataFrame([(True, False)], "src boolean, dst boolean"))


def test_busiest_source_needs_edges(spark):
    with pytest.raises(ValueError, match="no edges"):
        busiest_source(graph_of(spark, [], [1]))


def test_session_settings_and_caches_are_put_back(spark):
    keys = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k) for k in keys]
    graph = graph_of(spark, [(1, 2), (2, 3), (3, 1)])
    for algorithm in (lambda g: bfs(g, 1), wcc, lcc, lambda g: cdlp(g, 2), lambda g: pagerank(g, 2)):
        result = algorithm(graph)
        assert [spark.conf.get(k) for k in keys] == before
        assert not graph.edges.is_cached and result.count() == 3
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0
