"""Graph analytics on Spark DataFrames: a graph is a vertex table and an edge table."""

from weftgraph.graph import Graph
from weftgraph.operators.degrees import (
    dangling_count,
    dangling_vertices,
    in_degree,
    neighbour_count,
    out_degree,
    out_degree_nonzero,
    total_degree,
    transition_probabilities,
)
from weftgraph.operators.propagate import Superstep, propagate
from weftgraph.operators.triangles import corner_edges, triangle_count, triangles
from weftgraph.plans import ALGORITHMS, bfs, cdlp, lcc, pagerank, run, sssp, wcc
from weftgraph.sources.files import (
    read_edge_list,
    read_graph,
    read_vertex_list,
    write_edge_list,
    write_result,
    write_vertex_list,
)

__all__ = [
    "ALGORITHMS",
    "Graph",
    "Superstep",
    "bfs",
    "cdlp",
    "corner_edges",
    "dangling_count",
    "dangling_vertices",
    "in_degree",
    "lcc",
    "neighbour_count",
    "out_degree",
    "out_degree_nonzero",
    "pagerank",
    "propagate",
    "read_edge_list",
    "read_graph",
    "read_vertex_list",
    "run",
    "sssp",
    "total_degree",
    "transition_probabilities",
    "triangle_count",
    "triangles",
    "wcc",
    "write_edge_list",
    "write_result",
    "write_vertex_list",
]
