"""Edges laid out once for many rounds of message passing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from weftgraph.graph import Graph, both_ways
from weftgraph.operators import runtime, skew


@dataclass(frozen=True)
class Layout:
    """``cold`` edges are partitioned and sorted by ``src`` like the state is by ``id``, so they join in
    place. Edges of the few ``hot`` sources are split into parts of about an even share, ``spread`` by source
    and part, and each part meets a copy of its source's state.
    """

    cold: DataFrame
    spread: DataFrame | None
    hot: DataFrame | None
    partitions: int
    rows: int
    least_weight: float | None
    source: DataFrame | None = None

    def release(self) -> None:
        """Let go of the edges as they came, once the state is derived from them; the laid-out ones stay."""
        if self.source is not None and self.source.storageLevel != StorageLevel.NONE:
            for laid in (self.cold, self.spread):
                if laid is not None:
                    laid.count()
            self.source.unpersist()

    def of(self, edges: DataFrame, ids: list[int] | None) -> DataFrame:
        """Edges of few sources; the cache knows the least and greatest source of each batch and passes over the others."""
        return edges if ids is None else edges.where(F.col("src").isin(ids))

    def send(self, senders: DataFrame, message: Column, ids: list[int] | None = None) -> DataFrame:
        """One ``(id, msg)`` row per edge leaving a sender; ``senders`` has ``src`` and the state columns.

        ``ids`` are those of the senders, where they are few and known.
        """
        sent = self.of(self.cold, ids).join(senders, "src").select("dst", message.alias("msg"))
        if self.hot is None:
            return sent.withColumnRenamed("dst", "id")
        few = skew.repeated(senders, "src", self.hot)
        more = self.of(self.spread, ids).join(few, ["src", skew.SALT]).select("dst", message.alias("msg"))
        return sent.unionByName(more).withColumnRenamed("dst", "id")


@contextmanager
def arranged(graph: Graph, *, undirected: bool = False, weighted: bool = False) -> Iterator[Layout]:
    """Lay out the edges of ``graph`` and hold loop settings while the block runs.

    ``undirected`` adds the reverse of each edge when the graph is directed. The number of partitions follows
    edges and vertices, whichever are more, and is no larger than cores and memory ask for: the fewer they are, the more
    messages to one vertex are combined before they are shuffled.
    """
    spark = graph.edges.sparkSession
    cached = graph.edges.storageLevel != StorageLevel.NONE
    with graph.held():
        edges = graph.edges.select("src", "dst", *(["weight"] if weighted else []))
        if undirected and graph.directed:
            edges = both_ways(edges)
        least = F.min("weight") if weighted else F.lit(None).cast("double")
        out = edges.withColumn("edge", F.lit(1))
        ends = graph.vertices.select(F.col("id").alias("src"), F.lit(0).alias("edge"))
        per_source = (
            out.unionByName(ends, allowMissingColumns=True)
            .groupBy("src")
            .agg(F.sum("edge").alias("rows"), least.alias("least"))
        )
        totals = per_source.agg(F.sum("rows"), F.max("rows"), F.min("least"), F.count(F.lit(1))).first()
        rows, most = totals[0] or 0, totals[1] or 0
        partitions = runtime.partition_count(spark, max(rows, totals[3]), runtime.ROWS_PER_PARTITION)
        limit = skew.hot_threshold(rows, partitions)
        with runtime.loop_settings(spark, partitions):
            hot, cold, spread = None, edges, None
            if most > limit:
                hot = runtime.cut(skew.hot_keys(per_source, "src", "rows", limit))
                cold = edges.join(F.broadcast(hot.select("src")), "src", "left_anti")
                place = ("src", skew.SALT)
                spread = skew.dealt(edges, "src", hot).repartition(partitions, *place).sortWithinPartitions(*place)
                spread.persist(StorageLevel.MEMORY_AND_DISK)
            cold = cold.repartition(partitions, "src").sortWithinPartitions("src")
            cold.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                yield Layout(cold, spread, hot, partitions, rows, totals[2], None if cached else graph.edges)
            finally:
                cold.unpersist()
                if spread is not None:
                    spread.unpersist()
