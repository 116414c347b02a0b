"""PageRank with the rank of dangling vertices spread over all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from weftgraph.functions.combine import reduced_by
from weftgraph.graph import Graph
from weftgraph.operators.degrees import out_degree
from weftgraph.operators.layout import arranged
from weftgraph.operators.propagate import Superstep, iterate
from weftgraph.operators.runtime import cut


def pagerank(graph: Graph, iterations: int, damping: float = 0.85) -> DataFrame:
    """``(id, rank)`` after exactly ``iterations`` rounds from 1/N each; ranks sum to 1.

    Parallel edges count each, in the degree and in what is passed on.
    """
    with arranged(graph) as layout:
        watch = Observation()
        links = cut(out_degree(graph).withColumnRenamed("degree", "links"), watch, size=F.count(F.lit(1)))
        size = watch.get["size"]
        state = links.withColumn("rank", F.lit(1.0 / max(size, 1)))

        def update(step: Superstep):
            shared = (1.0 - damping) / size + damping / size * step.totals["dangling"]
            return {"rank": F.lit(shared) + damping * F.coalesce("msg", F.lit(0.0))}

        result = iterate(
            layout,
            state,
            message=F.col("rank") / F.col("links"),
            combine=reduced_by(F.sum),
            update=update,
            totals={"dangling": F.coalesce(F.sum(F.when(F.col("links") == 0, F.col("rank"))), F.lit(0.0))},
            max_iterations=iterations if size else 0,
        )
    return result.select("id", "rank")
