"""Graphs contained in the order-processing test tables, as tables any Spark user would derive.

Each reads whole tables. Lines of an order meet by exact line number only, so that edges grow with the rows as long
as a number repeats a bounded number of times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.graph import Graph, both_ways

# By default, lines of one order up to this many numbers apart make their parts neighbours.
REACH = 6
# Line numbers that meet in one group, at least.
BLOCK = 16
# Line numbers below this fit an order line's id.
LINE_NUMBERS = 1 << 20


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _meeting(lines: DataFrame, reach: int) -> DataFrame:
    """``(first, second)``: every two of ``lines(order, number, ...)`` of which the second is up to ``reach`` numbers ahead, as rows.

    Lines are gathered by order and block of numbers, so that each is shuffled once. A block's lines meet those of its own
    and the first ``reach`` numbers of the next; blocks are shifted by half, so that orders of few lines lie within one.
    Lines that come twice count once.
    """
    span = max(BLOCK, 2 * reach)
    at = F.col("number") + span // 2
    block = F.floor(at / span)
    # Numbers that the block before reaches are in that block too.
    blocks = F.when(F.pmod(at, F.lit(span)) < reach, F.array(block, block - 1)).otherwise(F.array(block))
    own = [c for c in lines.columns if c != "order"]
    gathered = lines.select("order", F.explode(blocks).alias("block"), F.struct(*own).alias("line"))
    together = gathered.groupBy("order", "block").agg(F.collect_set("line").alias("lines")).where(F.size("lines") > 1)
    first = together.select("block", "lines", F.explode("lines").alias("first"))
    first = first.where(F.floor((F.col("first.number") + span // 2) / span) == F.col("block"))
    ahead = F.filter("lines", lambda line: (line["number"] - F.col("first.number")).between(1, reach))
    return first.select("first", F.explode(ahead).alias("second"))


def _least(pairs: DataFrame) -> DataFrame:
    """One row per (src, dst), as a directed graph needs."""
    return pairs.groupBy("src", "dst").agg(F.min("weight").alias("weight"))


def _linked(pairs: DataFrame) -> DataFrame:
    """The undirected graph's edges, both ways, from pairs brought together once.

    The weight is the lesser of both directions' least ones, and null where a direction has rows but no weight.
    """
    rising = F.col("src") < F.col("dst")
    found = pairs.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(
        F.min(F.when(rising, F.col("weight"))).alias("up"),
        F.min(F.when(~rising, F.col("weight"))).alias("down"),
        F.bool_or(rising).alias("rises"),
        F.bool_or(~rising).alias("falls"),
    )
    missing = F.col("rises") & F.col("up").isNull() | F.col("falls") & F.col("down").isNull()
    return both_ways(found.select("src", "dst", F.when(~missing, F.least("up", "down")).alias("weight")))


def _graph(pairs: DataFrame, directed: bool, vertices: DataFrame | None = None) -> Graph:
    if not directed:
        return Graph.from_listed(_linked(pairs), vertices)
    return Graph.from_edges(_least(pairs)) if vertices is None else Graph.from_tables(vertices, _least(pairs))


def copurchase_pairs(spark: SparkSession, folder: str, reach: int = REACH) -> DataFrame:
    """``(src, dst, weight)``, a row for every two lines of an order, up to ``reach`` numbers apart, with different parts."""
    lines = _table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("part"),
        F.col("l_orderkey").alias("order"),
        F.col("l_linenumber").cast("long").alias("number"),
        F.col("l_quantity").alias("quantity"),
    )
    lines = lines.where(F.col("part").isNotNull() & F.col("order").isNotNull() & F.col("number").isNotNull())
    src, dst = F.col("first.part").alias("src"), F.col("second.part").alias("dst")
    weight = F.abs(F.col("first.quantity") - F.col("second.quantity")) + 1
    return _meeting(lines, reach).select(src, dst, weight.alias("weight")).where(F.col("src") != F.col("dst"))


def copurchase_edges(spark: SparkSession, folder: str, reach: int = REACH) -> DataFrame:
    """``(src, dst, weight)``: from the part of an order line to other parts on the next ``reach`` line numbers.

    Numbers repeat within an order and every line counts. The weight is one plus the least difference in
    quantity over all pairs of lines. Matching by exact number keeps an order's pairs in proportion to its lines.
    """
    return _least(copurchase_pairs(spark, folder, reach))


def copurchase(spark: SparkSession, folder: str, directed: bool = True) -> Graph:
    """Parts bought together, from all order lines."""
    return _graph(copurchase_pairs(spark, folder), directed)


def order_lines(spark: SparkSession, folder: str, directed: bool = True) -> Graph:
    """Order lines, each linked to the next number of its order: sparse, with one component or more per order.

    A vertex stands for a number of an order, ``l_orderkey * LINE_NUMBERS + l_linenumber``; numbers that don't fit fail
    the job. The weight is one plus the least difference in quantity between rows of the two numbers.
    """
    fits = F.col("l_linenumber").between(0, LINE_NUMBERS - 1)
    number = F.when(fits, F.col("l_linenumber")).otherwise(F.raise_error(F.lit("line number does not fit an id")))
    lines = _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("order"), number.cast("long").alias("number"), F.col("l_quantity").alias("quantity")
    )
    found = _meeting(lines.where("order is not null").select("*", F.col("order").alias("of")), 1)
    at = lambda row: F.col(f"{row}.of") * LINE_NUMBERS + F.col(f"{row}.number")
    weight = F.abs(F.col("first.quantity") - F.col("second.quantity")) + 1
    pairs = found.select(at("first").alias("src"), at("second").alias("dst"), weight.alias("weight"))
    ids = lines.select((F.col("order") * LINE_NUMBERS + F.col("number")).alias("id"))
    return _graph(pairs, directed, ids)


def copurchase_all_parts(spark: SparkSession, folder: str, directed: bool = True) -> Graph:
    """``copurchase`` over every part of the catalogue, bought or not."""
    parts = _table(spark, folder, "part").select(F.col("p_partkey").alias("id"))
    return _graph(copurchase_pairs(spark, folder), directed, parts)


def supplier_part(spark: SparkSession, folder: str, directed: bool = False) -> Graph:
    """Who supplied what: suppliers get odd ids and parts even ones, so there are no triangles."""
    lines = _table(spark, folder, "lineitem")
    edges = lines.select((2 * F.col("l_suppkey") + 1).alias("src"), (2 * F.col("l_partkey")).alias("dst"))
    return Graph.from_edges(edges.distinct(), directed)


def geography(spark: SparkSession, folder: str, directed: bool = True) -> Graph:
    """Customers and suppliers to their nation, nations to their region: few hubs hold all edges.

    Ids are four times the key, plus 0 for regions, 1 for nations, 2 for suppliers, 3 for customers.
    """
    hops = [
        ("nation", "n_nationkey", 1, "n_regionkey", 0),
        ("supplier", "s_suppkey", 2, "s_nationkey", 1),
        ("customer", "c_custkey", 3, "c_nationkey", 1),
    ]
    edges = None
    for name, child, kind, parent, above in hops:
        part = _table(spark, folder, name).select(
            (4 * F.col(child).cast("long") + kind).alias("src"), (4 * F.col(parent).cast("long") + above).alias("dst")
        )
        edges = part if edges is None else edges.unionByName(part)
    return Graph.from_edges(edges, directed)


def customer_chain(spark: SparkSession, folder: str, directed: bool = True) -> Graph:
    """Each customer to the one of the next key: few long paths, as many levels as customers.

    The weight is one more than the difference of their balances.
    """
    own = _table(spark, folder, "customer").select(F.col("c_custkey").cast("long").alias("src"), F.col("c_acctbal").alias("q"))
    following = own.select((F.col("src") - 1).alias("src"), F.col("src").alias("dst"), F.col("q").alias("balance"))
    edges = own.join(following, "src").select("src", "dst", (F.abs(F.col("q") - F.col("balance")) + 1).alias("weight"))
    return Graph.from_tables(own.select(F.col("src").alias("id")), edges, directed)


def busiest_source(graph: Graph) -> int:
    """The vertex with most out-edges, the smallest id among equals."""
    counts = graph.edges.groupBy("src").agg(F.count(F.lit(1)).alias("rows"))
    found = counts.orderBy(F.desc("rows"), "src").first()
    if found is None:
        raise ValueError("the graph has no edges")
    return found["src"]


GRAPHS: dict[str, Callable[..., Graph]] = {
    "copurchase": copurchase,
    "order_lines": order_lines,
    "copurchase_all_parts": copurchase_all_parts,
    "supplier_part": supplier_part,
    "geography": geography,
    "customer_chain": customer_chain,
}
