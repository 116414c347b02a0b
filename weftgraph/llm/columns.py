"""Columns of the caller kept apart from those an operator adds, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def numbered(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``frame`` with its columns called c0, c1 and so on, and those names by the old ones."""
    names = {name: f"c{i}" for i, name in enumerate(frame.columns)}
    return frame.toDF(*names.values()), names


def named(frame: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    """The old names again, and the columns ``more``, in place of old ones of the same name."""
    kept = [F.col(number).alias(name) for name, number in names.items() if name not in more]
    return frame.select(*kept, *more)
