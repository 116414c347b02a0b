"""Text edge lists and vertex lists, and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.graph import Graph


def _lines(spark: SparkSession, path: str, schema: str, sep: str) -> DataFrame:
    # A line that does not fit fails the read instead of becoming nulls.
    return spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path)


def read_edge_list(spark: SparkSession, path: str, *, weighted: bool = False, sep: str = " ") -> DataFrame:
    """Lines ``src dst``, or ``src dst weight``."""
    return _lines(spark, path, "src long, dst long" + (", weight double" if weighted else ""), sep)


def read_vertex_list(spark: SparkSession, path: str) -> DataFrame:
    """One vertex id per line."""
    return _lines(spark, path, "id long", " ")


def read_graph(
    spark: SparkSession,
    edges_path: str,
    vertices_path: str | None = None,
    *,
    directed: bool = True,
    weighted: bool = False,
    sep: str = " ",
) -> Graph:
    """A graph of an edge list and, if given, a vertex list, whose isolated vertices are kept."""
    edges = read_edge_list(spark, edges_path, weighted=weighted, sep=sep)
    if vertices_path is None:
        return Graph.from_edges(edges, directed)
    return Graph.from_tables(read_vertex_list(spark, vertices_path), edges, directed)


def write_edge_list(graph: Graph, path: str, *, sep: str = " ", mode: str = "errorifexists") -> None:
    """Write ``src dst[ weight]`` lines; an undirected edge is written in both directions, as held."""
    columns = ["src", "dst"] + (["weight"] if graph.weighted else [])
    graph.edges.select(*columns).write.mode(mode).option("sep", sep).csv(path)


def write_vertex_list(graph: Graph, path: str, *, mode: str = "errorifexists") -> None:
    """Write one vertex id per line."""
    graph.vertices.select("id").write.mode(mode).csv(path)


def write_result(
    result: DataFrame, path: str, *, format: str = "text", sep: str = " ", mode: str = "errorifexists"
) -> None:
    """Write an algorithm's rows as ``id value`` lines, or in a Spark format such as ``parquet``."""
    if format == "text":
        result.write.mode(mode).option("sep", sep).csv(path)
    else:
        result.write.mode(mode).format(format).save(path)
