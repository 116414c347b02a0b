"""Random graphs with hubs, loops, parallel edges and isolated vertices, against plain Python."""

import random

import pytest

import reference_results as py
from weftgraph import Graph, bfs, cdlp, corner_edges, lcc, pagerank, sssp, triangle_count, triangles, wcc
from weftgraph.operators import runtime, skew
from weftgraph.operators import triangles as triangle_module


def random_edges(seed, size, count):
    rng = random.Random(seed)
    ids = [rng.randrange(-1000, 10**12) for _ in range(size)]
    hub = ids[0]
    edges = [(rng.choice(ids), rng.choice(ids), float(rng.randint(0, 9))) for _ in range(count)]
    edges += [(hub, rng.choice(ids), 5.0) for _ in range(count // 3)]
    edges += [(rng.choice(ids), hub, 5.0) for _ in range(count // 4)]
    edges += [(ids[1], ids[1], 1.0), (ids[2], ids[3], 1.0), (ids[2], ids[3], 2.0), (ids[3], ids[2], 1.0)]
    return ids + [10**15, 10**15 + 1], edges


@pytest.fixture(params=["even", "split"])
def hot(request, monkeypatch):
    """``split`` makes hubs hot at this size, so that the paths for hot keys run."""
    if request.param == "split":
        monkeypatch.setattr(skew, "HOT_ROWS", 8)
        monkeypatch.setattr(runtime, "ROWS_WORTH_A_TASK", 20)
        monkeypatch.setattr(runtime, "ROWS_PER_PARTITION", 20)
        monkeypatch.setattr(triangle_module, "PIECE", 3)


def values(result):
    return {row[0]: row[1] for row in result.collect()}


@pytest.mark.parametrize("directed", [True, False], ids=["directed", "undirected"])
def test_all_algorithms(spark, hot, directed):
    ids, edges = random_edges(11, 60, 150)
    frame = spark.createDataFrame(edges, "src long, dst long, weight double")
    graph = Graph.from_tables(spark.createDataFrame([(i,) for i in ids], "id long"), frame, directed).checkpoint()
    vertices, listed = set(ids), edges if directed else py.undirected(edges)
    source = ids[5]
    assert values(bfs(graph, source)) == py.bfs(vertices, listed, source)
    assert values(sssp(graph, source)) == py.sssp(vertices, listed, source)
    assert values(wcc(graph)) == py.wcc(vertices, listed)
    assert values(cdlp(graph, 3)) == py.cdlp(vertices, listed, directed, 3)
    assert values(pagerank(graph, 4, 0.8)) == pytest.approx(py.pagerank(vertices, listed, 4, 0.8), abs=1e-12)
    assert values(lcc(graph)) == pytest.approx(py.lcc(vertices, listed), abs=1e-12)
    found = py.triangles(listed)
    rows = triangles(graph).collect()
    assert len(rows) == len(found) > 0 and {tuple(r) for r in rows} == found
    counts = values(triangle_count(graph))
    assert counts == {v: n for v in vertices if (n := sum(v in t for t in found))}
    assert sorted(tuple(r) for r in corner_edges(graph).collect()) == sorted(py.corner_edges(listed))


def test_hubs_are_found_hot(spark, hot, request):
    """The split case above is only worth something if hubs pass the threshold there."""
    from weftgraph.operators.layout import arranged

    _, edges = random_edges(11, 60, 150)
    graph = Graph.from_edges(spark.createDataFrame(edges, "src long, dst long, weight double"))
    with arranged(graph) as layout:
        split = "split" in request.node.name
        assert (layout.hot is not None) == split
        if split:
            assert 0 < layout.hot.count() <= layout.partitions / 2
            assert layout.cold.count() + layout.spread.count() == len(edges)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_long_paths(spark, seed):
    rng = random.Random(seed)
    ids = list(range(400))
    if seed:
        rng.shuffle(ids)
    cuts = {130, 131, 300}
    edges = [(a, b, 1.0) for i, (a, b) in enumerate(zip(ids, ids[1:])) if i not in cuts]
    graph = Graph.from_edges(spark.createDataFrame(edges, "src long, dst long, weight double"))
    assert values(wcc(graph)) == py.wcc({v for e in edges for v in e[:2]}, edges)


def test_components_with_hot_labels(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(runtime, "ROWS_WORTH_A_TASK", 10)
    rng = random.Random(5)
    ids = list(range(120))
    rng.shuffle(ids)
    edges = [(a, b, 1.0) for a, b in zip(ids, ids[1:])] + [(1000 + i, 1001 + i, 1.0) for i in range(10)]
    graph = Graph.from_edges(spark.createDataFrame(edges, "src long, dst long, weight double"))
    assert values(wcc(graph)) == py.wcc({v for e in edges for v in e[:2]}, edges)
