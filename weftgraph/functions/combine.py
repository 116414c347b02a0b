"""Combiners turn ``(id, msg)`` rows into one row per id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

Combiner = Callable[[DataFrame], DataFrame]


def reduced_by(aggregate: Callable[[str], Column]) -> Combiner:
    """Combine with an aggregate function such as ``F.min`` or ``F.sum``; partial results travel."""
    return lambda messages: messages.groupBy("id").agg(aggregate("msg").alias("msg"))


def most_frequent(messages: DataFrame) -> DataFrame:
    """The message received most often, the smallest one among equals.

    Counting by (id, msg) first spreads a vertex of very many neighbours over all tasks; what is left
    to gather by id is one best candidate per task.
    """
    counted = messages.groupBy("id", "msg").agg(F.count(F.lit(1)).alias("times"))
    return counted.groupBy("id").agg(F.min_by("msg", F.struct(-F.col("times"), "msg")).alias("msg"))
