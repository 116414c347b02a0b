"""The hand-sized graph of FIXTURES.md: every column of its two result tables."""

import pytest

from weftgraph import Graph, bfs, cdlp, lcc, pagerank, run, sssp, wcc
from weftgraph.plans.distances import UNREACHED_DISTANCE, UNREACHED_HOPS

EDGES = [
    (1, 2, 1.0), (1, 3, 4.0), (2, 3, 2.0), (3, 1, 1.0), (3, 4, 1.0),
    (4, 5, 3.0), (5, 4, 3.0), (6, 7, 0.5), (7, 8, 0.5), (6, 8, 2.0),
]
NO, INF = UNREACHED_HOPS, UNREACHED_DISTANCE
# Per vertex 1..9: hops, distance, component, label after 2 rounds, after 5, rank, coefficient.
DIRECTED = [
    (0, 0.0, 1, 1, 3, 0.070498157, 0.5),
    (1, 1.0, 1, 1, 1, 0.055875191, 1.0),
    (1, 3.0, 1, 3, 1, 0.104102235, 0.166667),
    (2, 4.0, 1, 4, 5, 0.319567933, 0.0),
    (3, 7.0, 1, 5, 4, 0.295454411, 0.0),
    (NO, INF, 6, 6, 6, 0.025460172, 0.5),
    (NO, INF, 6, 6, 6, 0.036308877, 0.5),
    (NO, INF, 6, 6, 6, 0.067272852, 0.5),
    (NO, INF, 9, 9, 9, 0.025460172, 0.0),
]
UNDIRECTED = [
    (0, 0.0, 1, 1, 1, 0.117527726, 1.0),
    (1, 1.0, 1, 1, 1, 0.117527726, 1.0),
    (1, 1.0, 1, 1, 1, 0.174277795, 0.333333),
    (2, 2.0, 1, 1, 1, 0.129966532, 0.0),
    (3, 5.0, 1, 3, 1, 0.074197153, 0.0),
    (NO, INF, 6, 6, 6, 0.122699387, 1.0),
    (NO, INF, 6, 6, 6, 0.122699387, 1.0),
    (NO, INF, 6, 6, 6, 0.122699387, 1.0),
    (NO, INF, 9, 9, 9, 0.018404908, 0.0),
]


@pytest.fixture(scope="module", params=[True, False], ids=["directed", "undirected"])
def case(spark, request):
    vertices = spark.createDataFrame([(i,) for i in range(1, 10)], "id long")
    edges = spark.createDataFrame(EDGES, "src long, dst long, weight double")
    graph = Graph.from_tables(vertices, edges, request.param)
    return graph, DIRECTED if request.param else UNDIRECTED


def values(result):
    return {row[0]: row[1] for row in result.collect()}


def expected(golden, column):
    return {i + 1: row[column] for i, row in enumerate(golden)}


def test_bfs(case):
    graph, golden = case
    result = bfs(graph, 1)
    assert result.columns == ["id", "hops"]
    assert values(result) == expected(golden, 0)


def test_sssp(case):
    graph, golden = case
    assert values(sssp(graph, 1)) == expected(golden, 1)


def test_wcc(case):
    graph, golden = case
    assert values(wcc(graph)) == expected(golden, 2)
    assert values(wcc(graph, max_iterations=100)) == expected(golden, 2)


def test_cdlp(case):
    graph, golden = case
    assert values(cdlp(graph, 2)) == expected(golden, 3)
    assert values(cdlp(graph, 5)) == expected(golden, 4)


def test_pagerank(case):
    graph, golden = case
    ranks = values(pagerank(graph, 10, 0.85))
    assert ranks == pytest.approx(expected(golden, 5), abs=1e-9)
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-12)


def test_lcc(case):
    graph, golden = case
    assert values(lcc(graph)) == pytest.approx(expected(golden, 6), abs=1e-6)


def test_run_by_acronym(case):
    graph, golden = case
    assert values(run("bfs", graph, source=1)) == expected(golden, 0)
    assert values(run("WCC", graph)) == expected(golden, 2)
    with pytest.raises(ValueError, match="unknown algorithm"):
        run("XYZ", graph)
