"""Edges in blocks of neighbouring vertices, so that a round reads only the blocks it has work for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from weftgraph.graph import Graph
from weftgraph.operators import runtime

runtime.travels(__name__)

BLOCK_EDGES = 2_000_000
"""Edges of a block, about: what a task holds at once. A source with more edges than that is hot."""
SAMPLE_EACH = 1_000
"""Ends of edges that a block's bounds are drawn from, about."""


@dataclass(frozen=True)
class Blocks:
    """``edges(block, src, dst[, weight])``, cached block by block and sorted by ``src``.

    A block holds the vertices of a range of ids; ``bounds`` has the first id of each. Edges of ``hot`` sources are in ``spread``,
    many tasks' share each, and in no block. The cache keeps the least and greatest block and source of each
    batch of its rows, so what a filter on either rules out is not read.
    """

    edges: DataFrame
    spread: DataFrame | None
    hot: np.ndarray
    bounds: np.ndarray
    partitions: int
    rows: int
    least_weight: float | None
    mean_weight: float

    def block_of(self, id: int) -> int:
        return int(blocks_of(self.bounds, np.array([id]))[0])

    def of(self, active: list[int]) -> DataFrame:
        """The edges of some blocks; of all where that is most of them."""
        return self.edges if 2 * len(active) > len(self.bounds) else self.edges.where(F.col("block").isin(active))


def blocks_of(bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The block of each id."""
    return np.maximum(np.searchsorted(bounds, ids, "right") - 1, 0)


def block_column(bounds: np.ndarray, id: str) -> Column:
    """The block of an id, as a column."""

    @F.pandas_udf("int")
    def found(ids: pd.Series) -> pd.Series:
        return pd.Series(blocks_of(bounds, ids.to_numpy()).astype(np.int32))

    return found(F.col(id))


def _bounds(edges: DataFrame, count: int, rows: int) -> np.ndarray:
    """First ids of about ``count`` ranges with about as many ends of edges each, from a sample of all of them."""
    if count == 1:
        return np.zeros(1, np.int64)
    some = edges.sample(min(1.0, SAMPLE_EACH * count / rows), seed=0)
    ends = some.select(F.explode(F.array("src", "dst")).alias("id"))
    parts = ends.repartitionByRange(count, "id").groupBy(F.spark_partition_id().alias("part")).agg(F.min("id").alias("least"))
    return np.sort(np.array([row["least"] for row in parts.collect()] or [0], np.int64))


@contextmanager
def blocked(graph: Graph, *, weighted: bool = False) -> Iterator[Blocks]:
    """Lay out the edges of ``graph`` in blocks, and hold loop settings while the block runs."""
    spark = graph.edges.sparkSession
    with graph.held():
        edges = graph.edges.select("src", "dst", *(["weight"] if weighted else []))
        weight = F.col("weight") if weighted else F.lit(1.0)
        finite = F.when(F.abs(weight) < float("inf"), weight)
        per_source = edges.groupBy("src").agg(
            F.count(F.lit(1)).alias("rows"), F.min(weight).alias("least"), F.sum(finite).alias("sum"), F.count(finite).alias("finite")
        )
        total = per_source.agg(
            F.sum("rows").alias("rows"), F.max("rows").alias("most"), F.min("least").alias("least"), (F.sum("sum") / F.sum("finite")).alias("mean")
        ).first()
        rows = total["rows"] or 0
        partitions = runtime.partition_count(spark, rows)
        count = max(partitions, -(-rows // BLOCK_EDGES))
        with runtime.loop_settings(spark, partitions):
            hot = np.zeros(0, np.int64)
            spread = None
            if (total["most"] or 0) > BLOCK_EDGES:
                # At most one for each BLOCK_EDGES edges.
                hot = np.array([r[0] for r in per_source.where(F.col("rows") > BLOCK_EDGES).select("src").collect()], np.int64)
                few = F.broadcast(spark.createDataFrame([(int(x),) for x in hot], "src long"))
                spread = edges.join(few, "src", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
                edges = edges.join(few, "src", "left_anti")
            bounds = _bounds(edges, count, rows) if rows else np.zeros(1, np.int64)
            laid = edges.withColumn("block", block_column(bounds, "src") if len(bounds) > 1 else F.lit(0))
            laid = laid.repartition(partitions, "block").sortWithinPartitions("block", "src").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                yield Blocks(laid, spread, np.sort(hot), bounds, partitions, rows, total["least"], total["mean"] or 1.0)
            finally:
                laid.unpersist()
                if spread is not None:
                    spread.unpersist()
