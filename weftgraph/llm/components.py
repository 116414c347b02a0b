"""Connected components of links between documents or vectors, hubs included."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftgraph.operators.runtime import cut


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` of every end of ``links(a, b)``: the smallest end that it reaches.

    Large-star and small-star steps in turn (Kiveris and others, 2014): each end's neighbours are hung on the
    smallest of them until nothing moves, in about log rounds. A hub's links are joined to its minimum, which is
    a table of its own, so that Spark can split them over tasks.
    """
    stars = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    seen = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = cut(_hung(both, F.col("b") > F.col("a")))
        stars = cut(_hung(stars, F.lit(True)))
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    roots = stars.select(F.col("b").alias("id")).distinct().withColumn("root", F.col("id"))
    return stars.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)


def _hung(links: DataFrame, moved) -> DataFrame:
    """Neighbours ``b`` of each ``a`` that are ``moved``, and ``a`` itself, hung on the smallest of all."""
    least = links.groupBy("a").agg(F.min("b").alias("_least"))
    least = cut(least.select("a", F.least("a", "_least").alias("_least")))
    hung = links.filter(moved).join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    own = least.select("a", F.col("_least").alias("b"))
    return hung.unionByName(own).filter("a <> b").distinct()
