"""The graph algorithms, and their dispatch by acronym."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weftgraph.graph import Graph
from weftgraph.plans.communities import cdlp
from weftgraph.plans.clustering import lcc
from weftgraph.plans.components import wcc
from weftgraph.plans.distances import bfs, sssp
from weftgraph.plans.ranks import pagerank

ALGORITHMS = {"BFS": bfs, "CDLP": cdlp, "LCC": lcc, "PR": pagerank, "SSSP": sssp, "WCC": wcc}


def run(name: str, graph: Graph, **parameters) -> DataFrame:
    """Run an algorithm by its acronym, in any case."""
    try:
        algorithm = ALGORITHMS[name.upper()]
    except KeyError:
        raise ValueError(f"unknown algorithm {name!r}; known are {', '.join(ALGORITHMS)}") from None
    return algorithm(graph, **parameters)


__all__ = ["ALGORITHMS", "bfs", "cdlp", "lcc", "pagerank", "run", "sssp", "wcc"]
