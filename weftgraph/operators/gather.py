"""Edges laid out by receiver, for messages that can't be combined on their way.

Vertices lie in blocks by a hash of their id. What a vertex sends travels once to each block that it has an edge to, not
along each edge, and meets the edges there. ``Received.most_frequent`` does so with arrays, a few rows for every two blocks, and
``Received.met`` with a row for each message and edge.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from weftgraph.graph import Graph, both_ways
from weftgraph.operators import packed, runtime, skew

# Edges of a block at most, on average: a task holds them, in about 100 bytes each.
BLOCK_EDGES = 4_000_000


@dataclass(frozen=True)
class Received:
    """``packed`` has the edges by receiver's block, and what each block sends to others, as arrays. Edges of the few receivers
    that are ``hot`` are in ``hot(block, src, dst)`` instead, in blocks of the sender's id, so that no block holds them all.
    ``per_receiver(dst, rows)`` has all vertices and how many edges each receives.
    """

    edges: DataFrame
    packed: DataFrame
    hot: DataFrame | None
    per_receiver: DataFrame
    blocks: int
    source: DataFrame | None = None

    @cached_property
    def cold(self) -> DataFrame:
        """``(block, src, dst)``: the edges of all other receivers in their receiver's block, sorted by ``src``."""
        return _laid(self.edges, "dst", self.blocks)

    @cached_property
    def routes(self) -> DataFrame:
        """``(home, id, block)``: the blocks that each vertex sends to along cold edges, in the vertex's own one."""
        # Those of a block are known there, so that a route travels once.
        routes = self.cold.select("block", "src").distinct()
        routes = routes.select(_block("src", self.blocks).alias("home"), F.col("src").alias("id"), "block")
        routes = routes.repartitionById(self.blocks, "home").sortWithinPartitions("home", "id")
        return routes.persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        """Let go of the edges as they came, once the state is derived from them; the laid-out ones stay."""
        if self.source is not None and self.source.storageLevel != StorageLevel.NONE:
            for laid in (self.packed, self.hot):
                if laid is not None:
                    laid.count()
            self.source.unpersist()

    def unpersist(self) -> None:
        rows = [vars(self).get(name) for name in ("cold", "routes")]
        for frame in (self.packed, self.hot, self.per_receiver, *rows):
            if frame is not None:
                frame.unpersist()

    def placed(self, state: DataFrame) -> DataFrame:
        """``state(id, ...)`` with the vertex's ``block``, partitioned and sorted like the edges are."""
        state = state.select(_block("id", self.blocks).alias("block"), *[c for c in state.columns if c != "block"])
        return state.repartitionById(self.blocks, "block").sortWithinPartitions("block", "id")

    def met(self, state: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The cold and the hot edges, with the columns of the sender's ``state(block, id, ...)``."""
        columns = [c for c in state.columns if c not in ("block", "id")]
        sent = self.routes.join(state.withColumnRenamed("block", "home"), ["home", "id"])
        sent = sent.select("block", F.col("id").alias("src"), *columns).repartitionById(self.blocks, "block")
        return self.cold.join(sent, ["block", "src"]), self.met_hot(state)

    def met_hot(self, state: DataFrame) -> DataFrame | None:
        """The hot edges, with the columns of the sender's ``state(block, id, ...)``, which is in the same block."""
        return None if self.hot is None else self.hot.join(state.withColumnRenamed("id", "src"), ["block", "src"])

    def most_frequent(self, state: DataFrame) -> DataFrame:
        """``(block, id, label, was)``: of each row of ``state(block, id, label)`` the label most frequent along its cold edges,
        the smallest of equals, or its own without any, and the one it has.
        """

        def of(*kinds: int) -> DataFrame:
            return self.packed.where(F.col("kind").isin(*kinds))

        sent = state.groupBy("block").cogroup(of(packed.ROUTE).groupBy("block")).applyInArrow(packed.send, packed.MESSAGES)
        sent = sent.repartitionById(self.blocks, "block")
        edges = of(packed.EDGES, packed.RECEIVERS)
        return edges.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(packed.most_frequent, packed.FOUND)


def _block(id: str, blocks: int) -> Column:
    return F.pmod(F.hash(id), F.lit(blocks))


def _laid(edges: DataFrame, by: str, blocks: int) -> DataFrame:
    edges = edges.select(_block(by, blocks).alias("block"), "src", "dst").repartitionById(blocks, "block")
    return edges.sortWithinPartitions("block", "src").persist(StorageLevel.MEMORY_AND_DISK)


def _packed(edges: DataFrame, both: bool, blocks: int) -> DataFrame:
    sent = edges.mapInArrow(partial(packed.scatter, blocks=blocks, both=both), packed.SCATTERED).repartitionById(blocks, "block")
    laid = sent.mapInArrow(partial(packed.lay_out, blocks=blocks), packed.LAID).repartitionById(blocks, "block")
    # By kind, so that the cache's batches of other kinds are passed over.
    return laid.sortWithinPartitions("block", "kind", "peer").persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def received(graph: Graph, *, undirected: bool = False) -> Iterator[Received]:
    """Lay out the edges of ``graph`` by receiver and hold loop settings while the block runs.

    ``undirected`` adds the reverse of each edge when the graph is directed.
    """
    spark = graph.edges.sparkSession
    cached = graph.edges.storageLevel != StorageLevel.NONE
    with graph.held():
        given = graph.edges.select("src", "dst")
        both = undirected and graph.directed
        edges = both_ways(given) if both else given
        ends = edges.select("dst", F.lit(1).alias("edge"))
        every = ends.unionByName(graph.vertices.select(F.col("id").alias("dst"), F.lit(0).alias("edge")))
        # Every vertex is in it, so that vertices that come from the edges are not derived again.
        per_receiver = runtime.hold(every.groupBy("dst").agg(F.sum("edge").alias("rows")))
        totals = per_receiver.agg(F.sum("rows"), F.max("rows"), F.count(F.lit(1))).first()
        rows, most = totals[0] or 0, totals[1] or 0
        fitting = min(BLOCK_EDGES, runtime.ROWS_PER_PARTITION)
        blocks = runtime.partition_count(spark, max(rows, totals[2]), fitting, fitting)
        limit = skew.hot_threshold(rows, blocks)
        with runtime.loop_settings(spark, blocks):
            cold, hot = edges, None
            if most > limit:
                named = F.broadcast(runtime.cut(skew.hot_keys(per_receiver, "dst", "rows", limit)).select("dst"))
                cold = edges.join(named, "dst", "left_anti")
                hot = _laid(edges.join(named, "dst", "left_semi"), "src", blocks)
            table = _packed(given, both, blocks) if hot is None else _packed(cold, False, blocks)
            laid = Received(cold, table, hot, per_receiver, blocks, None if cached else graph.edges)
            try:
                yield laid
            finally:
                laid.unpersist()
